"""What several text operators share: table readers, words and row identity."""

from pyspark.sql import DataFrame, functions as F

# The six ASCII white-space characters between words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark, sf_dir, table) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text):
    """The words of a text column in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def lower_ascii(text):
    """`text` with A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def n_words(text):
    """Number of words: the characters left when each word is cut to one mark."""
    return F.length(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w"), SPACE, "")).cast("long")


def own(name, df: DataFrame):
    """A column name that `df` does not have, so that extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
