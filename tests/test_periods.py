"""Pages and date ranges over questions laid out by period."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qa_analytics.operators import filters
from qa_analytics.schema import STORED_QUESTION_SCHEMA
from qa_analytics.session import staging_path
from qa_analytics.sources import periods

NEW_YEAR = dt.datetime(2024, 1, 1)


def laid_out(spark, dates, unit="month", ids=None):
    """A store of one question per (id, date)."""
    path = staging_path(spark, "test") + "/questions"
    named = zip(ids or range(len(dates)), dates)
    rows = spark.createDataFrame([(i, d and d.isoformat(" ")) for i, d in named], "question_id long, at string")
    rows = rows.withColumn("publication_date", F.col("at").cast("timestamp"))
    known = ("question_id", "publication_date")
    rows = rows.select(*(F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in STORED_QUESTION_SCHEMA))
    periods.write_periods(rows, path, unit)
    return path


def keys(page):
    return [tuple(r) for r in page.select("question_id", F.unix_micros("publication_date")).collect()]


def brute(spark, path):
    """All keys in page order, by a plain sort in Python."""
    rows = keys(periods.read_periods(spark, path))
    return sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is not None, r[0] or 0))


def walked(spark, path, size, unit):
    out, after = [], None
    while True:
        page = periods.page_after(spark, path, size, after, unit)
        found = keys(page)
        if not found:
            return out
        after = periods.last_key(page)
        out.append(found)


@pytest.mark.parametrize("unit", ["month", "day"])
def test_pages_follow_each_other_without_gap_or_overlap(spark, unit):
    dates = [NEW_YEAR + dt.timedelta(days=7 * (i % 13), hours=i % 2) for i in range(40)] + [None] * 6
    path = laid_out(spark, dates, unit)
    pages = walked(spark, path, 9, unit)
    assert [len(p) for p in pages] == [9, 9, 9, 9, 9, 1]
    assert sum(pages, []) == brute(spark, path)
    for skip in (0, 1, 9, 39, 40, 45):
        assert keys(periods.page_at(spark, path, 9, skip, unit)) == brute(spark, path)[skip:skip + 9]
    assert keys(periods.page_at(spark, path, 9, 46, unit)) == keys(periods.page_after(spark, path, 0, None, unit)) == []


def test_rows_with_one_key_and_rows_without_an_id_stay_together(spark):
    ids = [None, None, 4, 4, 4, 5, None]
    path = laid_out(spark, [NEW_YEAR] * 6 + [None], ids=ids)
    pages = walked(spark, path, 1, "month")
    assert [[k[0] for k in p] for p in pages] == [[None, None], [4, 4, 4], [5], [None]]
    assert sum(pages, []) == brute(spark, path)


def test_empty_and_missing_stores(spark):
    for path in (laid_out(spark, []), staging_path(spark, "test") + "/never"):
        assert periods.period_counts(spark, path) == []
        assert keys(periods.page_after(spark, path, 5)) == keys(periods.page_at(spark, path, 5, 3)) == []
        assert keys(periods.page_after(spark, path, 5, periods.Key(None, None))) == []
        assert keys(periods.published_between(spark, path, "2024-01-01", "2024-02-01")) == []


def test_a_range_has_both_ends_and_reads_only_its_periods(spark):
    path = laid_out(spark, [NEW_YEAR + dt.timedelta(days=i) for i in range(120)] + [None])
    found = periods.published_between(spark, path, "2024-01-31", "2024-02-02")
    assert sorted(k[0] for k in keys(found)) == [30, 31, 32]
    assert read_partitions(found) == {202401, 202402}
    whole = filters.in_date_range(periods.read_periods(spark, path), "2024-01-31", "2024-02-02")
    assert sorted(keys(whole)) == sorted(keys(found))


def read_partitions(df):
    """The periods whose files the scan of `df` opens."""
    node = df._jdf.queryExecution().sparkPlan()
    scans = [node.collectLeaves().apply(i) for i in range(node.collectLeaves().size())]
    scans = [s for s in scans if "FileSourceScan" in s.getClass().getName()]
    assert len(scans) == 1
    listed = scans[0].selectedPartitions().toPartitionArray()
    return {int(p.urlEncodedPath().split("period=")[1].split("/")[0]) for p in listed}


def test_a_deep_page_reads_one_or_two_periods(spark):
    path = laid_out(spark, [NEW_YEAR + dt.timedelta(days=i) for i in range(366)] + [None])
    assert len(periods.period_counts(spark, path)) == 13
    deep = periods.page_at(spark, path, 10, 300)
    assert keys(deep) == brute(spark, path)[300:310]
    assert len(read_partitions(deep)) <= 2
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(publication_date" in plan
    assert "offset" not in plan.lower() and "CartesianProduct" not in plan


@pytest.mark.parametrize("counts, size, first, expected", [
    ([], 5, None, []),
    ([(3, 2), (2, 9), (1, 9)], 5, None, [3, 2]),
    ([(3, 2), (2, 9), (1, 9)], 2, None, [3]),
    ([(3, 2), (2, 9), (1, 9)], 5, 2, [2, 1]),
    ([(3, 2), (1, 9), (0, 1)], 5, 2, [1]),
    ([(3, 2), (0, 4)], 5, 0, [0]),
    ([(3, 2)], 0, None, []),
])
def test_periods_of_a_page(counts, size, first, expected):
    assert periods.periods_of_page(counts, size, first) == expected


def test_added_rows_keep_the_files_of_other_periods(spark):
    path = laid_out(spark, [NEW_YEAR])
    periods.write_periods(periods.read_periods(spark, path).drop("period"), path + "2")
    more = periods.read_periods(spark, path + "2").withColumn("publication_date", F.lit("2024-03-05").cast("timestamp"))
    periods.write_periods(more.withColumn("question_id", F.lit(9).cast("long")), path, mode="append")
    assert periods.period_counts(spark, path) == [(202403, 1), (202401, 1)]
    assert [k[0] for k in keys(periods.page_after(spark, path, 5))] == [9, 0]
