"""Numbers, dates and addresses."""

from urllib.parse import urlsplit

from pyspark.sql import Column, functions as F

# Weekday names, Monday first.
WEEKDAY_NAMES = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
# Seconds of the first and the last moment that a timestamp can show.
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def as_timestamp(value) -> Column:
    """A literal UTC timestamp from text, a datetime or a Column."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def epoch_timestamp(col) -> Column:
    """F7; a missing value, or one outside the years 1 to 9999, is the epoch."""
    return F.timestamp_seconds(F.when(col.between(*EPOCH_RANGE), col).otherwise(F.lit(0).cast("long")))


def whole_number(col) -> Column:
    """Integer text to long; anything else is null."""
    text = F.trim(col)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))


def decimal_number(col) -> Column:
    """Decimal text to double; anything else is null."""
    text = F.trim(col)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), text.try_cast("double"))


def id_from_path(col) -> Column:
    """F8: the third element of a path split on slashes."""
    return whole_number(F.split(col, "/").getItem(2))


def absolute_url(col, base) -> Column:
    """an address seen on page `base`: with a scheme, with a host, rooted, relative, or just a query or fragment."""
    parts = urlsplit(base)
    origin = f"{parts.scheme}://{parts.netloc}"
    folder = parts.path.rpartition("/")[0] + "/"
    plain = F.regexp_replace(col, r"^(\./)+", "")
    return (
        F.when(col.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), col)
        .when(F.startswith(col, F.lit("//")), F.concat(F.lit(f"{parts.scheme}:"), col))
        .when(F.startswith(col, F.lit("/")), F.concat(F.lit(origin), col))
        .when(col == "", F.lit(base))
        .when(F.startswith(col, F.lit("?")), F.concat(F.lit(origin + parts.path), col))
        .when(F.startswith(col, F.lit("#")), F.concat(F.lit(base.partition("#")[0]), col))
        .otherwise(F.concat(F.lit(origin + folder), plain)))


def abbreviated_number(col) -> Column:
    """`12.3k`, `1.5m`, `1,234`; anything unreadable is 0."""
    text = F.lower(col)

    def scaled(letter, factor):
        return (decimal_number(F.replace(text, F.lit(letter), F.lit(""))) * factor).try_cast("long")

    value = (
        F.when(F.contains(text, F.lit("k")), scaled("k", 1000))
        .when(F.contains(text, F.lit("m")), scaled("m", 1000000))
        .otherwise(whole_number(F.replace(text, F.lit(","), F.lit(""))))
    )
    return F.coalesce(value, F.lit(0).cast("long"))


def iso_text(col) -> Column:
    """ISO date or date and time text to timestamp; anything else, a time alone included, is null."""
    return F.when(col.rlike(ISO_TIME), col.try_cast("timestamp"))


def iso_timestamp(col, as_of) -> Column:
    """ISO text to timestamp; unreadable or missing text gives `as_of`."""
    return F.coalesce(iso_text(col), as_timestamp(as_of))


def days_before(as_of, days) -> Column:
    """F14."""
    return as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def percent(part, whole) -> Column:
    """share in percent, 0 when the whole is 0."""
    return rate(part, whole) * 100


def rate(part, whole) -> Column:
    """quotient, 0 when the divisor is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def round_cents(col) -> Column:
    """Two decimals, halves to the even neighbour of the scaled value."""
    return F.rint(col * 100) / 100


def nan_to_null(col) -> Column:
    """P12."""
    return F.when(F.isnan(col), None).otherwise(col)


def weekday_name(col) -> Column:
    """F21."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.coalesce(F.get(names, col.cast("int")), F.concat(F.lit("Jour "), col.cast("string")))
