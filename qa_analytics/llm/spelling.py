"""Spelling variants of the words of a corpus, by reduced alphabets.

Words are counted over whole texts. Two words are near if one inserted, deleted
or replaced code point turns one into the other; the form of a word is its near
word of largest count, if that count is at least ten times its own.

Method: letters are hashed to a few symbols, so a word becomes a reduced word.
The reduced word of a near word is at most one edit away, hence in the one-edit
neighbourhood of the reduced word. Neighbourhoods are generated once for every
distinct reduced word and joined with the reduced vocabulary; where two reduced
words meet, their words are verified on the originals. Each pair is written
from one side only: by the longer word (its deletion is the other's insertion),
by the word with the larger symbol at the replaced place, or, where both have
the same reduced word, by the larger word. Keys are 64-bit hashes of reduced
words; a collision only adds a meeting that the verification refuses.

Sizes: the number of symbols follows from the size of the vocabulary, so that
reduced words of the least length stand for some `OCCUPANCY` words at most in
the mean; it changes the cost, not the result. A reduced word that stands for
more than `BUCKET` words does not take part: its words, and those that would
meet them, meet at four times as many symbols, up to one symbol per letter,
where every reduced word stands for one word. So no bucket is squared. Counts
fold before the shuffle, and nothing is collected.

Defined cases: a null text has no words, a null id is the empty text in the
hash that damages a run; repeated rows count again; ties between forms go to
the smallest word in code-point order; an empty table, or one without words
that repeat, gives no rows; other columns are ignored. A very long word makes
its neighbourhood in slices of bounded size.
"""

import math

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .common import lower_ascii

MIN_LENGTH, MIN_COUNT, FORM_FACTOR, DAMAGE = 7, 2, 10, 31
BUCKET, OCCUPANCY = 512, 128
# All letters of a run are below this code point.
LETTERS = 256
# Neighbours made at a time.
SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def vocabulary(docs: DataFrame, min_length=MIN_LENGTH, min_count=MIN_COUNT, damage=DAMAGE) -> DataFrame:
    """(word, n): the words of all texts, damaged runs included, that occur `min_count` times.

    Only runs of `min_length` letters can give a word, and a match of that many
    letters or more is a whole run.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(
            F.coalesce("text", F.lit("")), F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("doc", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    place = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    words = runs.select(F.when(h % damage == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def symbols_for(n_words, min_length=MIN_LENGTH):
    """The least number of symbols, four at least, at which reduced words of the least length stand for few words."""
    k = 4
    while k < LETTERS and k ** min_length * OCCUPANCY < n_words:
        k += 1
    return k


def symbol_of(points, k):
    """The symbol of each letter: ranges of a fixed shuffle of the letters, so more symbols split fewer."""
    return ((points * 11 % 32) * 8 + points // 32) * k // LETTERS


def _weights(k):
    """One 64-bit number per symbol."""
    x = np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _same_length(words):
    """(positions, code points) of the words of each length."""
    arrays = [np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32) for w in words]
    lengths = np.array([len(a) for a in arrays])
    for length in np.unique(lengths):
        where = np.flatnonzero(lengths == length)
        step = max(1, SLICE // max(int(length), 1))
        for start in range(0, len(where), step):
            part = where[start:start + step]
            yield part, np.stack([arrays[i] for i in part])


def _powers(n):
    p = np.ones(n, dtype=np.uint64)
    if n > 1:
        p[1:] = BASE
        p = np.multiply.accumulate(p)
    return p


def _sealed(h, length):
    """The key of a reduced word: its hash with its length mixed in."""
    h = h ^ np.uint64(int(length) * 0xD6E8FEB86659FD93 % (1 << 64))
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)).view(np.int64)


def reduced_keys(words, k):
    """The key of each word's reduced word."""
    keys, weights = np.zeros(len(words), dtype=np.int64), _weights(k)
    for part, points in _same_length(words):
        terms = weights[symbol_of(points, k)] * _powers(points.shape[1])
        keys[part] = _sealed(terms.sum(axis=1, dtype=np.uint64), points.shape[1])
    return keys


def neighbour_keys(words, k):
    """Slices (positions of words, keys, is itself): the reduced word, its deletions, its replacements by a smaller symbol."""
    weights = _weights(k)
    for part, points in _same_length(words):
        symbols = symbol_of(points, k)
        length = points.shape[1]
        powers = _powers(length)
        terms = weights[symbols] * powers
        whole = terms.sum(axis=1, dtype=np.uint64)
        yield part, _sealed(whole, length), True
        # The sum of the terms after a place, moved one place to the front.
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        shorter = before - terms + (whole[:, None] - before) * BACK
        # Equal symbols side by side give the same reduced word; the first of them stands for all.
        first = np.ones(symbols.shape, dtype=bool)
        first[:, 1:] = symbols[:, 1:] != symbols[:, :-1]
        rows, places = np.nonzero(first)
        yield part[rows], _sealed(shorter[rows, places], length - 1), False
        for symbol in range(k - 1):
            rows, places = np.nonzero(symbols > symbol)
            if len(rows):
                changed = whole[rows] - terms[rows, places] + weights[symbol] * powers[places]
                yield part[rows], _sealed(changed, length), False


def _keyed(words: DataFrame, k) -> DataFrame:
    """`words` (word, n, hot) with the key of each reduced word."""

    def keyed(batches):
        for batch in batches:
            keys = pa.array(reduced_keys(batch.column("word").to_pylist(), k))
            yield pa.RecordBatch.from_arrays([keys, *batch.columns], names=["key", "word", "n", "hot"])

    return words.mapInArrow(keyed, "key long, word string, n long, hot boolean")


def _neighbours(buckets: DataFrame, k) -> DataFrame:
    """(maker, key, itself): the neighbourhood of each reduced word, made from one of its words."""

    def made(batches):
        for batch in batches:
            makers = batch.column("key")
            for rows, keys, itself in neighbour_keys(batch.column("word").to_pylist(), k):
                yield pa.RecordBatch.from_arrays(
                    [makers.take(pa.array(rows)), pa.array(keys), pa.array(np.full(len(keys), itself))],
                    names=["maker", "key", "itself"])

    return buckets.select("key", F.col("members")[0]["word"].alias("word")).mapInArrow(
        made, "maker long, key long, itself boolean")


def near_words(words: DataFrame, symbols=None, bucket=BUCKET) -> DataFrame:
    """(a, n_a, b, n_b): every pair of near words of a vocabulary (word, n), once."""
    k = symbols or symbols_for(words.count())
    level, found = words.select("word", "n", F.lit(True).alias("hot")), None
    while True:
        keyed = durable(_keyed(level, k))
        hot = durable(keyed.groupBy("key").count().where(F.col("count") > bucket).select("key")) if k < LETTERS else None
        more = hot is not None and not hot.isEmpty()
        member = F.struct("word", "n", "hot")
        if more:
            # Reduced words that meet a large bucket, from either side, take their words along.
            one = durable(keyed.groupBy("key").agg(F.min("word").alias("word"), F.count("*").alias("size")))
            ways = _neighbours(one.select("key", F.array(F.struct("word")).alias("members")), k)
            large = one.where(F.col("size") > bucket).select("key")
            out_of = ways.join(large.withColumnRenamed("key", "maker"), "maker", "left_semi").select("key")
            into = ways.join(large, "key", "left_semi").select(F.col("maker").alias("key"))
            close = out_of.unionByName(into).distinct()
            level = durable(keyed.join(close, "key", "left_semi").join(
                large.withColumn("large", F.lit(True)), "key", "left").select("word", "n", F.col("large").isNotNull().alias("hot")))
            keyed = keyed.join(hot, "key", "left_anti")
        buckets = durable(keyed.groupBy("key").agg(F.collect_list(member).alias("members")))
        met = _neighbours(buckets, k).join(buckets.select("key", F.col("members").alias("others")), "key").select(
            F.col("maker").alias("key"), "itself", "others")
        met = met.join(buckets, "key").select("itself", "others", F.inline("members").alias("a", "n_a", "hot_a"))
        met = met.select("itself", "a", "n_a", "hot_a", F.inline("others").alias("b", "n_b", "hot_b"))
        # Two words whose reduced words both took part before have met before.
        pairs = met.where(
            (F.col("hot_a") | F.col("hot_b")) & (~F.col("itself") | (F.col("a") > F.col("b")))
            & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        k = min(LETTERS, 4 * k)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the links (word, form) lead to.

    Counts grow along the links, so there is no circle; each round doubles the
    number of links that a pointer has followed.
    """
    reached = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = durable(reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return reached
        reached = moved.select("word", "root")


def variants(docs: DataFrame, factor=FORM_FACTOR, symbols=None, bucket=BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = durable(vocabulary(docs))
    pairs = near_words(words, symbols, bucket)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    near = pairs.select(F.inline(both))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), "other")).alias("best"))
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.order") >= factor * F.col("n"), F.struct(
            F.col("best.other").alias("form"), (-F.col("best.order")).alias("form_n"))).alias("best"))
    judged = durable(judged.select("word", "n", "n_near", "best.form", "best.form_n"))
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
