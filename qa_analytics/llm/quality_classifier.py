"""Quality of documents by a regularised quadratic discriminant.

Statistics of a text (lengths, shares of kinds of characters, repetition, lines)
are brought to comparable scales by logarithms and roots. Each of the two
quality labels has a mean and a covariance of these numbers; a covariance is
shrunk towards the diagonal of the pooled variances, as if `PRIOR` documents a
statistic had been seen with it, and floored by `RIDGE`. A document's score is
the probability of label 1 from the difference of the two Gaussian log
densities, whose Mahalanobis distances come from Cholesky factors that are
computed once and sent to the tasks, and from the labels' shares.

The model is fitted on all labelled documents that `training` admits, without a
sample: every task adds up its moments, which are summed per entry, so the
driver sees 2 x (1 + d + d x d) sums for d statistics. Labels are added up per
document id before they meet the documents, and meet their statistics, not
their texts.

Defined cases: a null text is empty and has its statistics like any other;
labels that are null or neither 0 nor 1, or whose id is null, are ignored; a
document labelled several times counts as often, with each label it has;
documents that repeat an id are scored one by one and each count; if a label is
missing in training every score is the share of label 1 (a half without any);
no documents give no rows; other columns are ignored.
"""

import math
import unicodedata
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from ..session import durable

PRIOR, RIDGE = 4, 1e-3
# Number of statistics.
D = 15
SPACE, LETTER, CAPITAL, DIGIT, SYMBOL, STOP, PAUSE, SHOUT, MARK, OTHER = range(10)
CUT = 0.3


@cache
def _kinds():
    """The kind of every code point below 65,536; the others are OTHER."""
    kinds = np.full(1 << 16, OTHER, dtype=np.uint8)
    for point in range(1 << 16):
        char = chr(point)
        category = unicodedata.category(char)
        if char in " \t\n\v\f\r":
            kinds[point] = SPACE
        elif char in ".!?,;:":
            kinds[point] = {".": STOP, "!": SHOUT, "?": SHOUT}.get(char, PAUSE)
        elif category[0] == "S" or char in "#*%&@\\/_":
            kinds[point] = SYMBOL
        elif category[0] == "L":
            kinds[point] = CAPITAL if category == "Lu" else LETTER
        elif category == "Nd":
            kinds[point] = DIGIT
        elif category[0] == "P":
            kinds[point] = MARK
    return kinds


def text_statistics(text):
    """The `D` numbers of a text: logarithms of lengths, roots of shares.

    A share is out of a little more than the text has, so that one mark in a
    short text is not taken for a habit.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kinds()[np.minimum(points, (1 << 16) - 1)]
    count = np.bincount(kinds, minlength=OTHER + 1)
    chars = max(len(points) - count[SPACE], 1)
    # Splitting and stripping bytes goes by the six ASCII spaces.
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    lines = [x for x in map(bytes.strip, raw.split(b"\n")) if x]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    ends = (kinds == STOP) | (kinds == SHOUT)
    sentences = int((ends[:-1] & (kinds[1:] == SPACE)).sum()) + bool(len(ends) and ends[-1])
    w, x, n = len(words) + 10, len(lines) + 2, chars + 30
    shares = (
        (len(words) - len(set(words))) / w, sum(map(eq, words, words[1:])) / w,
        (len(lines) - len(set(lines))) / x, sum(y[-1] not in b".!?" for y in lines) / x,
        count[CAPITAL] / n, count[DIGIT] / n, count[SYMBOL] / n, (count[STOP] + count[PAUSE] + count[SHOUT]) / n,
        count[SHOUT] / n, count[MARK] / n, (len(points) - count[SPACE] - count[LETTER] - count[CAPITAL]) / n)
    return [math.log1p(len(words)), math.log1p(chars / n_words), math.log1p(len(words) / n_lines),
            math.log1p(len(words) / max(sentences, 1)), *map(math.sqrt, shares)]


def statistics(docs: DataFrame, learn) -> DataFrame:
    """(doc_id, learn, stats): one number per statistic of every document."""

    def measured(batches):
        for batch in batches:
            stats = [text_statistics(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learn"), pa.array(stats, pa.list_(pa.float64()))],
                names=["doc_id", "learn", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", learn.alias("learn"), "text").mapInArrow(
        measured, f"doc_id {kind}, learn boolean, stats array<double>")


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(stats, ones, zeros): the labelled rows of a table (doc_id, stats) with how often they have each label."""
    counts = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.count_if(F.col("quality") == 1).alias("ones"), F.count_if(F.col("quality") == 0).alias("zeros"))
    return stats.join(counts, "doc_id").select("stats", "ones", "zeros")


def moments(rows: DataFrame):
    """{label: (count, sum, sum of outer products)} of labelled statistics."""
    d = D

    def added(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist(), dtype=np.float64).reshape(-1, d)
            for label, name in ((0, "zeros"), (1, "ones")):
                n = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
                total[label, 0] += n.sum()
                total[label, 1:1 + d] += n @ x
                total[label, 1 + d:] += ((x * n[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["entry", "value"])

    sums = np.zeros(2 * (1 + d + d * d))
    for row in rows.mapInArrow(added, "entry long, value double").groupBy("entry").agg(F.sum("value").alias("value")).collect():
        sums[row["entry"]] = row["value"]
    return {label: (s[0], s[1:1 + d], s[1 + d:].reshape(d, d)) for label, s in enumerate(sums.reshape(2, -1))}


def fit(sums):
    """(share of label 1, scale, centre, [(mean, inverse Cholesky factor, log determinant) per label] or None)."""
    d = D
    counts = [sums[k][0] for k in (0, 1)]
    share = counts[1] / sum(counts) if sum(counts) else 0.5
    if min(counts) == 0:
        return share, np.ones(d), np.zeros(d), None
    means = [sums[k][1] / counts[k] for k in (0, 1)]
    spread = [sums[k][2] / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(n * np.diag(s) for n, s in zip(counts, spread)) / sum(counts)
    scale = 1 / np.sqrt(np.maximum(pooled, 1e-12))
    centre = (sums[0][1] + sums[1][1]) / sum(counts)
    classes = []
    for n, mean, s in zip(counts, means, spread):
        scaled = s * np.outer(scale, scale)
        strength = PRIOR * d
        shrunk = (n * scaled + strength * np.eye(d)) / (n + strength) + RIDGE * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        classes.append(((mean - centre) * scale, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
    return share, scale, centre, classes


def scores(model, x):
    """The probability of label 1 of each row of statistics."""
    share, scale, centre, classes = model
    if classes is None:
        return np.full(len(x), share)
    z = (x - centre) * scale
    density = [-0.5 * ((((z - mean) @ inverse.T) ** 2).sum(axis=1) + log_det) for mean, inverse, log_det in classes]
    odds = density[1] - density[0] + np.log(share) - np.log1p(-share)
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def classify(docs: DataFrame, labels: DataFrame, training) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; `training` tells from the id whether its labels may be learnt."""
    stats = durable(statistics(docs, training(F.col("doc_id"))))
    model = fit(moments(labelled(stats.where("learn"), labels)))

    def scored(batches):
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist(), dtype=np.float64).reshape(-1, D)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores(model, x))],
                names=["doc_id", "held_out", "score"])

    rows = stats.select("doc_id", (~F.col("learn")).alias("held_out"), "stats")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double").select(
        "*", (F.col("score") >= CUT).cast("int").alias("predicted"))
