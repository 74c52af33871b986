"""Lexicon sentiment.

Polarity is the mean over a text's lexicon words, 0 without any. It is an
approximation of a full sentiment engine and as good as the lexicon passed in;
thresholds, counts and means are exact.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import sentiment_class
from ..functions.text import is_blank, once, sentiment_tokens
from ..functions.values import percent
from ..functions.word_lists import INTENSITY_WORDS, NEGATIONS, SENTIMENT_WORDS


# A lexicon up to this size is written into the expression.
MOST_WORDS = 2000


def default_lexicon(spark) -> DataFrame:
    """(word, polarity, intensity): sentiment words have a polarity, scaling words an intensity."""
    rows = [(w, p, None) for w, p in SENTIMENT_WORDS.items()]
    rows += [(w, None, i) for w, i in INTENSITY_WORDS.items() if w not in SENTIMENT_WORDS]
    return spark.createDataFrame(rows, "word string, polarity double, intensity double")


def _in_row(tokens, polarity, intensity, negations):
    """Mean polarity of an array of words; 0 without a sentiment word. `polarity` and `intensity` are dicts."""
    if not polarity:
        return F.lit(0.0)

    def value(table, word):
        entries = [F.lit(x) for item in table.items() for x in item]
        return F.try_element_at(F.create_map(*entries), word) if entries else F.lit(None).cast("double")

    def score(i):
        before, before2 = F.get(tokens, i - 1), F.get(tokens, i - 2)
        scale = value(intensity, before)
        scaled = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value(polarity, F.get(tokens, i)) * F.coalesce(scale, F.lit(1.0))))
        negated = before.isin(negations) | (scale.isNotNull() & before2.isin(negations))
        return F.when(F.coalesce(negated, F.lit(False)), scaled * -0.5).otherwise(scaled)

    words = list(polarity)
    places = F.array_compact(F.transform(tokens, lambda w, i: F.when(w.isin(words), i)))
    return F.aggregate(
        F.transform(places, score), F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), (acc["n"] + 1).alias("n")),
        lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]).otherwise(0.0))


def _joined(corpus: DataFrame, lexicon: DataFrame, negations) -> DataFrame:
    """`scored` for a lexicon too large for an expression: words meet it in a join and come back by row."""
    polar = lexicon.where(F.col("polarity").isNotNull()).select("word", "polarity")
    scaling = lexicon.where(F.col("intensity").isNotNull()).select(F.col("word").alias("before"), "intensity")
    docs = corpus.select("source", "doc", is_blank(F.col("text")).alias("blank"), F.monotonically_increasing_id().alias("row"),
                         once(sentiment_tokens(F.col("text"))).alias("tokens"))
    gap = F.lit(None).cast("string")
    # The shifted arrays are longer, so each text has rows without a word past its last one.
    placed = F.arrays_zip("tokens", F.concat(F.array(gap), "tokens").alias("b1"),
                          F.concat(F.array(gap, gap), "tokens").alias("b2"))
    words = docs.select("source", "doc", "blank", "row", F.inline(placed).alias("word", "before", "before2"))
    found = words.join(polar, "word", "left").where("word is null or polarity is not null").join(scaling, "before", "left")
    scaled = F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), F.col("polarity") * F.coalesce("intensity", F.lit(1.0))))
    negated = F.col("before").isin(negations) | (
        F.col("intensity").isNotNull() & F.col("before2").isin(negations))
    score = F.when(F.coalesce(negated, F.lit(False)), scaled * -0.5).otherwise(scaled)
    return found.groupBy("source", "doc", "blank", "row").agg(
        F.coalesce(F.avg(F.when(F.col("polarity").isNotNull(), score)), F.lit(0.0)).alias("polarity")).select(
        "source", "doc", F.when(~F.col("blank"), F.col("polarity")).alias("polarity"))


def scored(corpus: DataFrame, lexicon: DataFrame, negations=NEGATIONS) -> DataFrame:
    """(source, doc, polarity) of every text; null for a blank one.

    A lexicon of up to `MOST_WORDS` entries becomes part of the expression, and
    texts are scored inside their row; a larger one is joined.
    """
    negations = list(negations)
    entries = lexicon.select("word", "polarity", "intensity").limit(MOST_WORDS + 1).collect()
    if len(entries) > MOST_WORDS:
        return _joined(corpus, lexicon, negations)
    polarity = {r["word"]: r["polarity"] for r in entries if r["word"] is not None and r["polarity"] is not None}
    intensity = {r["word"]: r["intensity"] for r in entries if r["word"] is not None and r["intensity"] is not None}
    docs = corpus.select("source", "doc", once(F.when(~is_blank(F.col("text")), sentiment_tokens(F.col("text")))).alias("tokens"))
    return docs.select("source", "doc", once(F.when(
        F.col("tokens").isNotNull(), _in_row(F.col("tokens"), polarity, intensity, negations))).alias("polarity"))


def text_polarity(corpus: DataFrame, lexicon: DataFrame, negations=NEGATIONS) -> DataFrame:
    """(source, doc, polarity) of every text that is not blank; 0 without a sentiment word.

    A scaling word right before a sentiment word multiplies it (kept inside
    [-1, 1]); a negation before either turns it round and halves it.
    """
    return scored(corpus, lexicon, negations).where(F.col("polarity").isNotNull())


def sentiment_summary(corpus: DataFrame, lexicon: DataFrame, negations=NEGATIONS) -> DataFrame:
    """Per source positive, negative and neutral texts, mean polarity and total; blank texts are left out.

    A source whose texts are all blank still has its row.
    """
    kind = sentiment_class(F.col("polarity"))
    return scored(corpus, lexicon, negations).groupBy("source").agg(
        *(F.count_if(F.col("polarity").isNotNull() & (kind == k)).alias(k) for k in ("positive", "negative", "neutral")),
        F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("average"), F.count("polarity").alias("total"))


def sentiment_share(summary: DataFrame) -> DataFrame:
    """B2: (source, class, texts, share in percent); sources without text give no row."""
    classes = ("positive", "neutral", "negative")
    rows = F.array(*[F.struct(F.lit(c).alias("sentiment"), F.col(c).alias("texts")) for c in classes])
    return summary.where(F.col("total") > 0).select("source", "total", F.inline(rows)).select(
        "source", "sentiment", "texts", percent(F.col("texts"), F.col("total")).alias("share"))


def classify(scores: DataFrame) -> DataFrame:
    """Add the class of each scored text."""
    return scores.withColumn("sentiment", sentiment_class(F.col("polarity")))
