"""Mixing sources to target weights by cube-method balanced sampling.

Sizes are word counts. Each source gets a share of all words by its weight; a
source whose share exceeds `max_repeat` times its size gets that much, and the
excess is shared again by weight until none is above. A document of a source
with ratio target / size is taken floor(ratio) times, and once more with a
probability equal to the rest. These inclusion probabilities are rounded by the
cube method: three documents at a time, they move along the direction that
keeps both the sum of words and the sum of documents, until one of them is 0
or 1. Every block of a source leaves at most two undecided; these form new
blocks, until one block is left, whose last two documents are the landing:
first the document count is let go, then the last one is drawn.

Blocks hold about `BLOCK` documents and are dealt by a hash, so a hot source is
many small tasks. Only (source, id, size, hash) moves, never the text. Random
numbers come from seeds made of source and block: reruns agree.

Rows that agree in id, source and text are one unit with several copies; the
words taken are divided among them evenly. Null sources form one source, last
in the order of weights; null texts have size 0 and are never taken. An empty
table gives an empty mix. Other columns are ignored (or pass through in `mix`).
"""

import random

from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable, released
from .common import n_words, own

BLOCK = 1024
WEIGHTS = (1, 2, 3)
EPS = 1e-9


def _units(docs, id, source, text):
    """(doc_id, source, size, k1, k2, n): one row per distinct id, source and text."""
    id, source, text = F.col(f"`{id}`"), F.col(f"`{source}`"), F.col(f"`{text}`")
    return docs.select(
        id.alias("doc_id"), source.alias("source"), n_words(text).alias("size"), *_keys(id, source, text)
    ).groupBy("doc_id", "source", "size", "k1", "k2").agg(F.count("*").alias("n"))


def _keys(id, source, text):
    parts = [x for c in (id, source, text) for x in (c.isNull(), c)]
    return F.xxhash64(*parts).alias("k1"), F.hash(*parts).alias("k2")


def targets(units: DataFrame, weights=WEIGHTS, max_repeat=3) -> DataFrame:
    """(source, source_size, units, target): words to take from each source."""
    sizes = durable(units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("units")))
    # One row per source: the order of sources needs them in one place.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = durable(sizes.withColumn("weight", weight))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > max_repeat * F.col("source_size") if capped >= 0 else F.lit(False)
        held, n, free = weighed.agg(
            F.sum(F.when(above, max_repeat * F.col("source_size")).otherwise(0)),
            F.sum(above.cast("int")), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if n is None or n == capped or not free:
            break
        level, capped = (total - held) / free, n
    return weighed.select(
        "source", "source_size", "units",
        F.least(F.lit(float(level)) * F.col("weight"), (max_repeat * F.col("source_size")).cast("double")).alias("target"))


def flight(sizes, chances, rng, land=False):
    """Move `chances` (a list, changed in place) to 0 or 1, keeping both balances; at most two stay between.

    With `land` the rest is decided too.
    """
    active = []

    def move(v):
        up = min((1 - chances[i]) / x if x > 0 else chances[i] / -x for i, x in zip(active, v) if x)
        down = min(chances[i] / x if x > 0 else (1 - chances[i]) / -x for i, x in zip(active, v) if x)
        step = up if rng.random() * (up + down) < down else -down
        for i, x in zip(active, v):
            chances[i] = min(1.0, max(0.0, chances[i] + step * x))
        stay = [i for i in active if EPS < chances[i] < 1 - EPS]
        for i in active:
            if i not in stay:
                chances[i] = round(chances[i])
        active[:] = stay

    for i, chance in enumerate(chances):
        if not EPS < chance < 1 - EPS:
            chances[i] = round(chance)
            continue
        active.append(i)
        while len(active) == 3:
            a, b, c = (sizes[i] for i in active)
            move((b - c, c - a, a - b) if a != b or b != c else (1, -1, 0))
        if len(active) == 2 and sizes[active[0]] == sizes[active[1]]:
            move((1, -1))
    while land and active:
        if len(active) == 2:
            a, b = (sizes[i] for i in active)
            move((b, -a) if a or b else (1, -1))
        else:
            chances[active[0]] = int(rng.random() < chances[active[0]])
            active.clear()


UNIT = "doc_id {id}, source string, size long, k1 long, k2 int, n long, whole long, chance double, blocks long"


def _fly(key, rows):
    rows = rows.sort_values(["k1", "k2", "size"], kind="stable")
    blocks = int(rows["blocks"].iloc[0])
    rng = random.Random(f"{key[0]}/{int(key[1])}/{blocks}")
    chances = rows["chance"].tolist()
    flight(rows["size"].tolist(), chances, rng, land=blocks == 1)
    return rows.assign(chance=chances)[["doc_id", "source", "size", "k1", "k2", "n", "whole", "chance", "blocks"]]


def decisions(docs: DataFrame, id="doc_id", source="source", text="text", weights=WEIGHTS, max_repeat=3) -> DataFrame:
    """(doc_id, source, size, k1, k2, n, source_size, target, total): `total` copies of each unit of n rows are taken."""
    units = durable(_units(docs, id, source, text))
    goal = durable(targets(units, weights, max_repeat))
    same = F.col("s").eqNullSafe(F.col("source"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("n")
    side = goal.withColumnRenamed("source", "s").withColumn("blocks", F.ceil(F.col("units") / BLOCK))
    open_ = units.join(side, same).select(
        *units.columns, F.floor(ratio + EPS).alias("whole"),
        F.greatest(ratio - F.floor(ratio + EPS), F.lit(0.0)).alias("chance"), "blocks")
    schema = UNIT.format(id=units.schema["doc_id"].dataType.simpleString())
    done = []
    while True:
        block = F.pmod(F.xxhash64("k1", "k2", "blocks"), F.col("blocks"))
        flown = durable(open_.groupBy("source", block.alias("block")).applyInPandas(_fly, schema))
        undecided = (F.col("chance") > EPS) & (F.col("chance") < 1 - EPS)
        done.append(flown.where(~undecided))
        rest = flown.where(undecided)
        if rest.isEmpty():
            break
        again = rest.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count("*") / BLOCK).alias("b"))
        open_ = rest.join(durable(again), same).drop("s", "blocks").withColumnRenamed("b", "blocks")
    decided = done[0]
    for part in done[1:]:
        decided = decided.unionByName(part)
    return decided.join(side.drop("blocks", "units"), same).select(
        "doc_id", "source", "size", "k1", "k2", "n", "source_size", "target",
        (F.col("whole") + F.round("chance").cast("long")).alias("total"))


def _shares():
    """One row per row of a unit: how often that row is taken."""
    each, more = F.expr("total div n"), F.col("total") % F.col("n")
    return F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "n"), lambda i: each + (i <= more).cast("long")))


def taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per row of `docs`, words taken from it."""
    return decisions(docs, **options).select("doc_id", "size", "source_size", "target", _shares().alias("copies")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id="doc_id", source="source", text="text", **options) -> DataFrame:
    """The mix itself: the columns of `docs`, every row as often as it is taken."""
    total, n, k1, k2 = (own(f"mix_{c}", docs) for c in ("total", "n", "k1", "k2"))
    wanted, = released(docs.sparkSession, lambda: (decisions(docs, id, source, text, **options).where(
        "total > 0 and size > 0").select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("n").alias(n), F.col("total").alias(total)),))
    a, b = _keys(*(F.col(f"`{c}`") for c in (id, source, text)))
    rows = docs.withColumn(k1, a).withColumn(k2, b)
    # One kind of join at every size: the decisions, a few numbers a document, are hashed, and texts are not sorted.
    single = rows.join(wanted.where(f"{n} = 1").hint("shuffle_hash"), [k1, k2])
    several = rows.join(wanted.where(f"{n} > 1").hint("shuffle_hash"), [k1, k2]).dropDuplicates([k1, k2])
    return single.unionByName(several).select(
        *(f"`{c}`" for c in docs.columns), F.explode(F.sequence(F.lit(1).cast("long"), total)).alias(own("mix_i", docs))
    ).select(*(f"`{c}`" for c in docs.columns))
