"""TF-IDF keyword ranking (A14) for several text sources in one plan.

The corpus is a frame (source, doc, text). Documents are tokenised inside
their row, once; their tokens are kept in the shared folder and read twice.
The first pass counts words. A pair of neighbours is never more frequent than
either of its words, so the second keeps, for each document, the counts of the
words that are at least as frequent as the last one that could enter the
vocabulary, and of the pairs of two such words; rare pairs, nearly all of
them, are never built or moved. The vocabulary, at most `max_features` terms
per source, and the weights come from these short lists: a document weights
and normalises its terms inside its row, and only (term, share) leaves it.
"""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.labels import KEYWORD_BANDS, band
from ..functions.lemmas import noun_lemma, noun_lemmas
from ..functions.text import clean_words, combined_text, kept_tokens, once, text_or_empty
from ..functions.word_lists import STOP_WORDS
from ..session import durable

# Vocabulary size and rows reported per source.
MAX_FEATURES = {"title": 50, "summary": 50, "combined": 100}
TOP_KEYWORDS = {"title": 20, "summary": 20, "combined": 30}

# So many words at most become part of the expression that looks for pairs; with more of them all pairs are counted.
PAIRED_WORDS = 2000


def question_texts(questions: DataFrame, sources=("title", "summary", "combined")) -> DataFrame:
    """(source, doc, text) rows of the wanted text sources."""
    texts = {
        "title": text_or_empty(F.col("title")),
        "summary": text_or_empty(F.col("summary")),
        "combined": combined_text(F.col("title"), F.col("summary")),
    }
    rows = F.array(*[F.struct(F.lit(s).alias("source"), texts[s].alias("text")) for s in sources])
    return questions.select(F.col("question_id").alias("doc"), F.inline(rows))


def tokenised(corpus: DataFrame, stop_words=STOP_WORDS, lemmas: DataFrame = None) -> DataFrame:
    """(source, doc, row, tokens) of documents that keep a token; `row` tells repeated ids apart.

    Words become noun lemmas inside their row. `lemmas` is an optional (token,
    lemma) table that goes before the rules; only then are tokens taken out of
    their row, joined and put back in order.
    """
    docs = corpus.select("source", "doc", F.monotonically_increasing_id().alias("row"), once(clean_words(F.col("text"))).alias("words"))
    docs = docs.select("source", "doc", "row", once(kept_tokens(F.col("words"), stop_words)).alias("tokens"))
    if lemmas is None:
        docs = docs.select("source", "doc", "row", once(noun_lemmas(F.col("tokens"))).alias("tokens"))
    else:
        table = lemmas.select(F.col("token"), F.col("lemma")).dropDuplicates(["token"])
        docs = (
            docs.select("source", "doc", "row", F.posexplode("tokens").alias("pos", "token"))
            .join(table, "token", "left")
            .groupBy("source", "doc", "row")
            .agg(F.array_sort(F.collect_list(
                F.struct("pos", F.coalesce("lemma", noun_lemma(F.col("token"))).alias("token")))).alias("placed"))
            .select("source", "doc", "row", F.col("placed.token").alias("tokens"))
            .withColumn("tokens", F.filter("tokens", lambda t: F.length(t) > 1))
        )
    return docs.where(F.size("tokens") > 0)


def question_tokens(questions: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """(title, summary, combined): tokens of the three text sources of a question, every text cleaned once.

    The combined text has the tokens of the title, then those of the summary: addresses end at the blank between them.
    Only markup may reach across it, so titles with a `<` have their combined text cleaned on its own; elsewhere
    `combined` is null.
    """
    title, summary = F.col("title"), F.col("summary")
    words = {
        "title": clean_words(title), "summary": clean_words(summary),
        "combined": F.when(F.contains(title, F.lit("<")), clean_words(combined_text(title, summary))),
    }
    rows = questions.select(once(F.struct(*[w.alias(s) for s, w in words.items()])).alias("words"))
    for step in (lambda w: kept_tokens(w, stop_words), noun_lemmas):
        rows = rows.select(once(F.struct(*[step(F.col(f"words.{s}")).alias(s) for s in words])).alias("words"))
    return rows.select("words.*")


def _terms(tokens):
    """Single tokens and pairs of neighbours; no pair where one of them is null."""
    pairs = F.zip_with(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), F.slice(tokens, 2, F.size(tokens)),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(tokens, pairs)


def term_frequencies(docs: DataFrame, terms=_terms) -> DataFrame:
    """(source, term, tf, df); the row with a null term holds the number of documents.

    A document's terms are sorted in its row and each is put next to the one
    before it, so the first of a run marks the document and no shuffle by
    document is needed. The second array is one longer, which gives each
    document one row without a term.
    """
    ordered = docs.select("source", once(F.sort_array(terms(F.col("tokens")))).alias("terms"))
    shifted = F.concat(F.array(F.lit(None).cast("string")), "terms")
    first_of_run = (~F.col("term").eqNullSafe(F.col("previous"))).cast("long")
    return (
        ordered.select("source", F.inline(F.arrays_zip("terms", shifted.alias("previous"))).alias("term", "previous"))
        .groupBy("source", "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.sum(first_of_run).alias("df"))
    )


def _bounded(stats: DataFrame) -> DataFrame:
    """(source, term, tf, df, n, max_df): terms that enough documents have."""
    n = F.col("n")
    sizes = stats.where(F.col("term").isNull()).select("source", F.col("tf").alias("n"))
    min_df = F.greatest(F.lit(1), F.least(F.lit(2), F.floor(n * 0.1)))
    max_df = F.when(n <= 5, 0.95).when(n <= 10, 0.9).otherwise(0.8) * n
    terms = stats.where(F.col("term").isNotNull()).join(F.broadcast(sizes), "source").withColumn("max_df", max_df)
    return terms.where((F.col("df") >= min_df) & (max_df >= min_df))


def _vocabulary(stats: DataFrame, max_features) -> DataFrame:
    """(source, term, tf, n, idf): terms inside the document-frequency bounds, the most frequent ones kept.

    Every task keeps its first terms of a source before the ranks are taken.
    """
    inside = _bounded(stats).where(F.col("df") <= F.col("max_df"))
    limit = F.create_map(*[F.lit(x) for item in max_features.items() for x in item])
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("tf"), "term"))
    return inside.withColumn("place", place).where(
        F.col("place") <= F.lit(max(max_features.values()))).where(F.col("place") <= F.try_element_at(limit, F.col("source"))).select(
        "source", "term", "tf", "n", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def _pair_words(stats: DataFrame, max_features, most):
    """{source: words} whose pairs may enter the vocabulary; None if there are more than `most`.

    As soon as single words fill the vocabulary, a pair enters it only with the frequency of the last of them, and both
    its words are as frequent. Words in nearly all documents count here: their pairs may be inside the bounds.
    """
    filled = {}
    for row in _vocabulary(stats, max_features).collect():
        filled.setdefault(row["source"], []).append(row["tf"])
    least = {s: min(found) for s, found in filled.items() if len(found) == max_features[s]}
    needed = F.lit(0)
    for source, tf in least.items():
        needed = F.when(F.col("source") == source, tf).otherwise(needed)
    rows = _bounded(stats).where(F.col("tf") >= needed).select("source", "term").limit(most + 1).collect()
    if len(rows) > most:
        return None
    return {s: [r["term"] for r in rows if r["source"] == s] for s in {r["source"] for r in rows}}


def keyword_scores(corpus: DataFrame, max_features=MAX_FEATURES, stop_words=STOP_WORDS, lemmas=None) -> DataFrame:
    """(source, term, score) of the whole vocabulary; empty when no term is inside the bounds.

    `max_features` maps each source of the corpus to its vocabulary size.
    """
    return token_scores(durable(tokenised(corpus, stop_words, lemmas).select("source", "tokens")), max_features)


def question_scores(questions: DataFrame, max_features=MAX_FEATURES, stop_words=STOP_WORDS, lemmas=None) -> DataFrame:
    """`keyword_scores` of the titles, summaries and combined texts of questions; each text is tokenised and kept once."""
    if lemmas is not None:
        return keyword_scores(question_texts(questions), max_features, stop_words, lemmas)
    kept = durable(question_tokens(questions, stop_words))
    tokens = {"title": F.col("title"), "summary": F.col("summary"), "combined": F.coalesce("combined", F.concat("title", "summary"))}
    rows = F.array(*[F.struct(F.lit(s).alias("source"), tokens[s].alias("tokens")) for s in tokens])
    return token_scores(kept.select(F.inline(rows)).where(F.size("tokens") > 0), max_features)


def token_scores(docs: DataFrame, max_features=MAX_FEATURES, paired_words=PAIRED_WORDS) -> DataFrame:
    """A14 on (source, tokens) rows, which are read twice."""
    stats = durable(term_frequencies(docs, lambda tokens: tokens))
    counts = durable(_term_counts(docs, _pair_words(stats, max_features, paired_words)))
    pairs = counts.select("source", F.inline("counts")).where(F.contains("term", F.lit(" "))).groupBy("source", "term").agg(
        F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df"))
    # At most `max_features` rows per source, written into the expression.
    vocabulary = _vocabulary(stats.unionByName(pairs), max_features).collect()
    spark = docs.sparkSession
    if not vocabulary:
        return spark.createDataFrame([], "source string, term string, score double")
    shares = counts.select("source", F.inline(_shares(vocabulary)).alias("term", "share"))
    sizes = F.create_map(*[F.lit(x) for s, n in {r["source"]: r["n"] for r in vocabulary}.items() for x in (s, n)])
    return shares.groupBy("source", "term").agg(F.sum("share").alias("share")).select(
        "source", "term", (F.col("share") / F.element_at(sizes, F.col("source"))).alias("score"))


def _term_counts(docs, words):
    """(source, counts): each document's listed words and the pairs of them with their counts; `words` None lists all.

    Terms are sorted, so the number of times a term occurs is the distance
    between its first position and the next term's.
    """
    tokens = F.col("tokens")
    if words is not None:
        # Words that are not listed become null and break the pairs.
        tokens = F.array().cast("array<string>")
        for source, known in words.items():
            listed = F.transform("tokens", lambda t: F.when(t.isin(known), t))
            tokens = F.when(F.col("source") == source, listed).otherwise(tokens)
    found = docs.select("source", once(tokens).alias("tokens")).select(
        "source", once(F.sort_array(F.filter(_terms(F.col("tokens")), lambda t: t.isNotNull()))).alias("found"))
    found = found.select("source", "found", once(F.array_distinct("found")).alias("terms"))
    found = found.select("source", "found", "terms", once(F.transform("terms", lambda t: F.array_position("found", t))).alias("first"))
    ends = F.concat(F.slice("first", 2, F.greatest(F.size("first") - 1, F.lit(0))), F.array(F.size("found").cast("long") + 1))
    counts = F.zip_with("terms", F.zip_with("first", ends, lambda x, y: y - x), lambda t, n: F.struct(t.alias("term"), n.alias("n")))
    return found.where(F.size("found") > 0).select("source", counts.alias("counts"))


def _shares(vocabulary):
    """(term, share) of a document's vocabulary terms: its weights over their length."""
    whole = F.array().cast("array<struct<term:string,share:double>>")
    for source in {r["source"] for r in vocabulary}:
        known = {r["term"]: r["idf"] for r in vocabulary if r["source"] == source}
        idf = F.create_map(*[F.lit(x) for item in known.items() for x in item])
        weighted = F.transform(
            F.filter("counts", lambda c: c["term"].isin(list(known))),
            lambda c: F.struct(c["term"].alias("term"), (c["n"] * F.try_element_at(idf, c["term"])).alias("weight")))

        def normalised(weighted):
            length = F.sqrt(F.aggregate(weighted, F.lit(0.0), lambda acc, w: acc + w["weight"] * w["weight"]))
            return _let(length, lambda x: F.transform(weighted, lambda w: F.struct(
                w["term"].alias("term"), (w["weight"] / x).alias("share"))))

        # Each step is bound to a name once; an expression used twice would be evaluated twice.
        whole = F.when(F.col("source") == source, _let(weighted, normalised)).otherwise(whole)
    return whole


def _let(value, use):
    """`use(value)` with `value` evaluated once, also inside an expression."""
    return F.transform(F.array(value), use)[0]


def top_keywords(scores: DataFrame, limits=None) -> DataFrame:
    """The best terms of each source with rank and significance."""
    limits = limits or TOP_KEYWORDS
    # A source without a limit keeps its whole vocabulary.
    limit = F.create_map(*[F.lit(x) for item in limits.items() for x in item])
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("score"), "term"))
    # The scores are at most a vocabulary per source.
    return (
        scores.withColumn("rank", place.cast("long")).where(F.coalesce(F.col("rank") <= F.try_element_at(limit, F.col("source")), F.lit(True)))
        .select("source", "rank", "term", "score", band(F.col("score"), KEYWORD_BANDS).alias("significance"))
    )
