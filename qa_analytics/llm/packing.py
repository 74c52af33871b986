"""Packing into length buckets that are optimal for the whole corpus.

Lengths are counted into a global histogram; dynamic programming chooses the
bucket boundaries with the least padding; inside each bucket documents form
batches of at most `budget` padded tokens (a document longer than that is a
batch of its own).

The histogram has one bin per length up to 1024 and 64 bins per doubling
above, so it is bounded (about 2,400 bins up to 2^31 tokens); a boundary is the
largest length seen in its bin. Documents are numbered inside a bucket by
blocks of a hash: counts per block are added up, and only rows of one block are
sorted together, so a hot bucket is many small tasks.

Texts that are null or without words have length 0 and are packed with the
shortest. Repeated rows are packed each. An empty table gives no batch.
"""

import numpy as np

from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .common import n_words

BUDGET = 32_768
BUCKETS = 16
FINE, PER_DOUBLING = 1024, 64
BLOCK = 2048


def length_bin(n):
    """Bin of a length column: the length itself, or steps of 1/64 of the power of two below it."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double") + 0.5))) / PER_DOUBLING
    return F.when(n <= FINE, n).otherwise((F.ceil(n / step) * step).cast("long"))


def boundaries(counts, tops, buckets):
    """Last bins of at most `buckets` runs of bins with the least padded total; bins come in order of length."""
    m, tops = len(counts), np.asarray(tops, np.float64)
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    # cost[j]: the least padded total of the first j bins in the runs so far.
    cost, starts, totals = np.append(0.0, np.full(m, np.inf)), [], []
    for _ in range(min(buckets, m)):
        table = cost[:-1, None] + tops * (before[1:] - before[:-1, None])
        table[np.tril_indices(m, -1)] = np.inf
        starts.append(table.argmin(0))
        cost = np.append(np.inf, table.min(0))
        totals.append(cost[m])
    ends, j = [], m
    for k in reversed(range(int(np.argmin(totals)) + 1 if totals else 0)):
        ends.append(j - 1)
        j = int(starts[k][j - 1])
    return ends[::-1]


def pack(docs: DataFrame, id="doc_id", text="text", buckets=BUCKETS, budget=BUDGET, length=None) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, position): one row per row of `docs`.

    `length` is a column with token counts; without it words count. Batches
    are numbered inside their bucket from 0.
    """
    n = n_words(F.col(f"`{text}`")) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    sized = durable(docs.select(
        F.col(f"`{id}`").alias("doc_id"), n.alias("n_tokens"), F.xxhash64(F.col(f"`{text}`")).alias("h")
    ).withColumn("bin", length_bin(F.col("n_tokens"))))
    bins = sorted(tuple(r) for r in sized.groupBy("bin").agg(F.count("*"), F.max("n_tokens")).collect())
    ends = boundaries([r[1] for r in bins], [max(r[2], 1) for r in bins], buckets)
    tops = [max(bins[e][2], 1) for e in ends]
    total = sum(r[1] for r in bins)
    bucket, top = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i in reversed(range(len(ends))):
        inside = F.col("bin") <= bins[ends[i]][0]
        bucket, top = F.when(inside, i).otherwise(bucket), F.when(inside, tops[i]).otherwise(top)
    block = F.pmod(F.xxhash64("doc_id", "n_tokens", "h"), F.lit(total // BLOCK + 1))
    placed = sized.select("doc_id", "n_tokens", "h", bucket.alias("bucket"), top.cast("long").alias("bucket_length"),
                          block.alias("block"))
    ahead = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = durable(placed.groupBy("bucket", "block").count().select(
        "bucket", "block", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before")))
    in_block = Window.partitionBy("bucket", "block").orderBy("n_tokens", "doc_id", "h")
    place = F.col("before") + F.row_number().over(in_block) - 1
    capacity = F.greatest(F.floor(F.lit(budget) / F.col("bucket_length")), F.lit(1))
    return placed.join(before, ["bucket", "block"]).withColumn("place", place).select(
        "doc_id", "n_tokens", "bucket", "bucket_length", F.floor(F.col("place") / capacity).alias("batch"),
        (F.col("place") % capacity).alias("position"))
