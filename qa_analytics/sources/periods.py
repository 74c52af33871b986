"""Questions laid out by period of publication, for pages and date ranges.

A table is a folder with one partition per month (or day); undated questions
have period 0. Rows are dealt out by range of (date, id), so a period with a
large part of all rows is split over many tasks and files, and each file covers
a short span of dates.

A page goes from newest to oldest, id ascending on ties (no id first), undated
questions last. It is addressed by the key of the row before it, so turning
pages never counts through what was read: the periods from the key on are
chosen by their row counts (from file footers), two columns of these give the
key of the page's last row, and full rows are read between the two keys only.
Rows that agree in date and id share a key and stay on one page, which is then
longer than asked for.

The number of periods is bounded by the calendar (Spark's dates have the years
1 to 9999); it is the only thing, besides a key, that reaches the driver.
"""

from typing import NamedTuple, Optional

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import as_timestamp
from ..operators.ranking import with_position
from ..schema import STORED_QUESTION_SCHEMA
from ..session import exists, released

DATE, ID = "publication_date", "question_id"
NEWEST_FIRST = (F.desc_nulls_last, F.asc_nulls_first)
LATEST_LAST = (F.asc_nulls_first, F.desc_nulls_last)
UNDATED = 0


class Key(NamedTuple):
    """Place of a row in the order: its date in microseconds of the epoch (None: undated) and its id."""
    micros: Optional[int]
    id: Optional[int]


def period_of(date, unit="month"):
    """Number of a date's period, rising with the date: 202401 (month) or 20240131 (day)."""
    if unit not in ("month", "day"):
        raise ValueError("unit is 'month' or 'day'")
    month = F.year(date) * 100 + F.month(date)
    return F.coalesce(month if unit == "month" else month * 100 + F.day(date), F.lit(UNDATED)).cast("int")


def _order(directions):
    return [way(name) for way, name in zip(directions, (DATE, ID))]


def write_periods(questions: DataFrame, path, unit="month", mode="overwrite") -> None:
    """Make the table, or add rows to it (`mode="append"`), sorted inside every file."""
    rows = questions.select(*STORED_QUESTION_SCHEMA.fieldNames()).withColumn("period", period_of(F.col(DATE), unit))
    rows.repartitionByRange("period", DATE, ID).sortWithinPartitions("period", DATE, ID).write.mode(mode).partitionBy(
        "period").parquet(path)


def read_periods(spark, path) -> DataFrame:
    """The whole table with its `period` column; a table not written yet is empty."""
    schema = T.StructType([*STORED_QUESTION_SCHEMA.fields, T.StructField("period", T.IntegerType())])
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def published_between(spark, path, start, end, unit="month") -> DataFrame:
    """P5: both ends included; only the periods between them are read."""
    first, last = as_timestamp(start), as_timestamp(end)
    rows = read_periods(spark, path).where(F.col("period").between(period_of(first, unit), period_of(last, unit)))
    return rows.where(F.col(DATE).between(first, last)).drop("period")


def period_counts(spark, path) -> list:
    """(period, rows) from newest to oldest, undated last."""
    counted = read_periods(spark, path).groupBy("period").count().collect()
    return sorted(((r["period"], r["count"]) for r in counted), reverse=True)


def periods_of_page(counts, size, first=None) -> list:
    """The periods that a page of `size` rows needs, newest first; rows of `first`, the period of the key before it, may be
    used up already, so they do not count."""
    chosen, found = [], 0
    for period, n in counts:
        if found >= size:
            break
        if first is None or period <= first:
            chosen.append(period)
            found += n if period != first else 0
    return chosen


def _date(key):
    return F.timestamp_micros(F.lit(key.micros))


def _beyond(key):
    """Rows that come after a key."""
    further = F.col(ID).isNotNull() if key.id is None else F.col(ID) > key.id
    if key.micros is None:
        return F.col(DATE).isNull() & further
    return (F.col(DATE) < _date(key)) | F.col(DATE).isNull() | ((F.col(DATE) == _date(key)) & further)


def _until(key):
    """Rows that come before a key or have it."""
    upto = F.col(ID).isNull() if key.id is None else F.col(ID).isNull() | (F.col(ID) <= key.id)
    if key.micros is None:
        return F.col(DATE).isNotNull() | upto
    return (F.col(DATE) > _date(key)) | ((F.col(DATE) == _date(key)) & upto)


def _key(rows: DataFrame):
    """The key of the only row of `rows`; None without a row."""
    row = rows.select(F.unix_micros(DATE).alias("micros"), F.col(ID).alias("id")).first()
    return row and Key(row["micros"], row["id"])


def last_key(page: DataFrame):
    """The key that addresses the page after this one; None for an empty page."""
    return _key(page.orderBy(*_order(LATEST_LAST)).limit(1))


def page_after(spark, path, size, after: Key = None, unit="month") -> DataFrame:
    """The `size` rows that follow the key `after` (the newest ones without a key), in order."""
    first = None
    if after is not None:
        date = F.lit(None).cast("timestamp") if after.micros is None else _date(after)
        first = spark.range(1).select(period_of(date, unit).alias("p")).first()["p"]
    rows = read_periods(spark, path).where(F.col("period").isin(periods_of_page(period_counts(spark, path), size, first)))
    if after is not None:
        rows = rows.where(_beyond(after))
    last = last_key(rows.select(DATE, ID).orderBy(*_order(NEWEST_FIRST)).limit(size))
    page = rows.limit(0) if last is None else rows.where(_until(last))
    return page.drop("period").orderBy(*_order(NEWEST_FIRST))


def key_at(spark, path, position):
    """The key of the row at a 0-based position; None beyond the end.

    Whole periods before it are skipped by their counts; rows are numbered
    inside one period only, over all its partitions.
    """
    for period, n in period_counts(spark, path):
        if position < n:
            keys = read_periods(spark, path).where(F.col("period") == period).select(DATE, ID)
            found, = released(spark, lambda: (with_position(keys, *_order(NEWEST_FIRST)).where(
                F.col("position") == position).drop("position"),))
            return _key(found)
        position -= n
    return None


def page_at(spark, path, size, skip=0, unit="month") -> DataFrame:
    """T1 by number: the page after the first `skip` rows, for a reader who has no key yet."""
    before = key_at(spark, path, skip - 1) if skip else None
    if skip and before is None:
        return read_periods(spark, path).drop("period").limit(0)
    return page_after(spark, path, size, before, unit)
