"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal vectors are one class with a weight. Centroids are fitted on a sample of
at most `SAMPLE` vectors (and `SAMPLE_VALUES` numbers); every vector is put into
its nearest cell and into each cell whose border is within `margin`, so cells
overlap where links may cross a border. Inside a cell (a shard) each vector's
nearest candidates are pruned to a sparse graph: a neighbour stays unless one
that stays already is closer to it by the factor `ALPHA`. The adjacency lists
of all shards are united, and every vector searches its shards from their
medoids: greedy at first, then every node within range is expanded until none
is left. All links are confirmed by cosine in double precision.

Audit: in every shard a bounded set of queries is compared with brute force,
and the search widens until every query has all its links; where it still
misses one at `WIDEST`, as beside large groups of near copies, all pairs of the
shard, which is of bounded size, are compared. Over the whole table, a bounded
set of queries is compared with all vectors, and if the mean recall of those
that have links is less than `FLOOR`, with queries that link with each other
counted as one, everything is repeated with the margin that no pair within
range can escape (half its largest distance).

A shard of more than `PART` vectors is split by a hash into parts with a graph
each, and its vectors search all of them, so no task holds more than a part
and a bounded run of queries. Links are counted, never listed.

Defined cases: vectors that are null, empty, all zero or hold null or
non-finite numbers link with nothing; vectors of different length do not link;
rows that repeat an id are one node; a null id gets no component and is kept;
ties go to the smallest id. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .components import connected_components

SAMPLE, SAMPLE_VALUES = 20_000, 8_000_000
CELL, PART, MOST_CELLS = 1024, 4096, 2048
MARGIN = 0.05
CANDIDATES, DEGREE, ALPHA = 48, 24, 1.2
BEAM, QUERIES, PAIRS, AUDITED, FLOOR, WIDEST = 24, 512, 16_384, 256, 0.98, 96


def unit(rows):
    """Vectors of length one, in double precision; the largest number is taken out first, so nothing overflows."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x, k, rounds=8):
    """Spherical k-means on a sample."""
    rng = np.random.RandomState(7)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        home = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.maximum(norms, 1e-12), c)
    return c


def distances(c):
    """Distances between centroids, from their products, so that no more than k x k numbers are held; never too small."""
    square = np.einsum("kd,kd->k", c, c)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * (c @ c.T), 0) + 1e-12)


def memberships(x, c, margin, apart=None):
    """For every vector a row of flags: its home cell and those whose border is near; `apart`: `distances(c)`, if at hand."""
    s = x @ c.T
    home = s.argmax(1)
    apart = distances(c) if apart is None else apart
    near = s[np.arange(len(x)), home][:, None] - s <= margin * apart[home]
    near[np.arange(len(x)), home] = True
    return near


def pruned_graph(x):
    """Neighbour lists over a shard: nearest candidates, robustly pruned, both ways, every node reachable."""
    n = len(x)
    if n == 1:
        return [np.empty(0, np.int64)]
    m = min(CANDIDATES, n - 1)
    edges = []
    for at in range(0, n, 256):
        rows = np.arange(at, min(at + 256, n))
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -2
        cand = np.argpartition(-s, m - 1, axis=1)[:, :m]
        order = np.argsort(-np.take_along_axis(s, cand, 1), axis=1, kind="stable")
        cand = np.take_along_axis(cand, order, 1)
        far = np.maximum(2 - 2 * np.take_along_axis(s, cand, 1), 0)  # squared distances
        y = x[cand]
        between = np.maximum(2 - 2 * (y @ y.transpose(0, 2, 1)), 0)
        open_, kept = np.ones(cand.shape, bool), np.zeros(cand.shape, bool)
        for j in range(m):
            take = open_[:, j] & (kept.sum(1) < DEGREE)
            kept[take, j] = True
            open_ &= ~(take[:, None] & (ALPHA ** 2 * between[:, j, :] <= far))
        i, j = np.nonzero(kept)
        edges.append(np.stack([rows[i], cand[i, j]], 1))
    edges = np.concatenate(edges)
    edges = np.unique(np.concatenate([edges, edges[:, ::-1]]), axis=0)
    lists = np.split(edges[:, 1], np.searchsorted(edges[:, 0], np.arange(1, n)))
    # Groups that the graph leaves apart are tied to the medoid's by their nearest pair with it.
    seen = np.zeros(n, bool)
    front = [medoid(x)]
    while True:
        seen[front] = True
        while front:
            front = [v for v in set(np.concatenate([lists[u] for u in front]).tolist()) if not seen[v]]
            seen[front] = True
        rest = np.flatnonzero(~seen)
        if not len(rest):
            return lists
        a, inside = rest[0], np.flatnonzero(seen)
        b = inside[(x[inside] @ x[a]).argmax()]
        lists[a], lists[b] = np.append(lists[a], b), np.append(lists[b], a)
        front = [a]


def medoid(x):
    return int((x @ x.mean(0)).argmax())


def search(x, lists, queries, low, beam):
    """Flags (query, node) of the nodes within range `low` that range-expanding greedy search finds."""
    n = len(x)
    found = np.zeros((len(queries), n), bool)
    if not n:
        return found
    sizes, flat = np.array([len(own) for own in lists]), np.concatenate(lists)
    starts = sizes.cumsum() - sizes
    start = medoid(x)
    for at in range(0, len(queries), QUERIES):
        q = queries[at:at + QUERIES]
        # Similarity of the nodes met so far; expanded nodes are taken out of `left`.
        met = np.full((len(q), n), -np.inf)
        left = met.copy()
        met[:, start] = left[:, start] = q @ x[start]
        # One node at a time while the search is still on its way.
        for _ in range(beam):
            best = left.argmax(1)
            row = np.flatnonzero(left[np.arange(len(q)), best] > -np.inf)
            if not len(row):
                break
            best = best[row]
            left[row, best] = -np.inf
            size = sizes[best]
            a = np.repeat(row, size)
            b = flat[np.arange(len(a)) + np.repeat(starts[best] - (size.cumsum() - size), size)]
            fresh = met[a, b] == -np.inf
            a, b = a[fresh], b[fresh]
            met[a, b] = left[a, b] = similarities(q, x, a, b)
        # Then every node in range is expanded, for all queries together; their order does not matter.
        front, unmet = (left >= low).T, (met == -np.inf).T
        while front.any():
            reached = np.zeros((n, len(q)), bool)
            for node in np.flatnonzero(front.any(1)):
                reached[lists[node]] |= front[node]
            reached &= unmet
            unmet &= ~reached
            b, a = np.nonzero(reached)
            s = similarities(q, x, a, b)
            met[a, b] = s
            front = np.zeros((n, len(q)), bool)
            front[b[s >= low], a[s >= low]] = True
        found[at:at + QUERIES] = met >= low
    return found


def similarities(q, x, a, b):
    """Cosines of the pairs (q[a], x[b]), a bounded number of them at a time."""
    s = np.empty(len(a))
    for at in range(0, len(a), PAIRS):
        some = slice(at, at + PAIRS)
        s[some] = np.einsum("pd,pd->p", q[a[some]], x[b[some]])
    return s


def _matrix(column, n):
    return unit(np.concatenate([np.asarray(v) for v in column]).reshape(n, -1))


def _build(key, rows):
    rows = rows.sort_values("id", kind="stable")
    ids = rows["id"].to_numpy()
    lists = pruned_graph(_matrix(rows["v"], len(rows)))
    return rows[["id"]].assign(neighbours=[ids[own] for own in lists])


def _search(low):
    def run(key, rows):
        rows = rows.sort_values(["node", "id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        x, n = _matrix(rows["v"], len(rows)), int(rows["node"].sum())
        ids, weight = rows["id"].to_numpy(), rows["w"].to_numpy()
        place = {v: i for i, v in enumerate(ids[:n].tolist())}
        lists = [np.array([place[v] for v in own if v in place], np.int64) for own in rows["neighbours"][:n]]
        # Audit a bounded, evenly spread set of queries; widen until nothing is missed there, at last to all pairs.
        some, beam = np.unique(np.linspace(0, len(x) - 1, 64).astype(int)), BEAM
        truth = x[some] @ x[:n].T >= low
        while beam <= WIDEST and (truth & ~search(x[:n], lists, x[some], low, beam)).any():
            beam *= 2
        # A pair is counted in the first cell that its two vectors share.
        cells = np.unique(np.concatenate([np.asarray(c) for c in rows["cells"]]))
        inside = np.zeros((len(x), len(cells)), bool)
        for i, own in enumerate(rows["cells"]):
            inside[i, np.searchsorted(cells, own)] = True
        before = inside[:, :np.searchsorted(cells, key[1])].astype(np.float32)
        found = np.zeros((len(x), n), bool)
        first = 0 if key[2] == key[3] else n
        for at in range(first, len(x), QUERIES):
            some = x[at:at + QUERIES]
            found[at:at + QUERIES] = search(x[:n], lists, some, low, beam) if beam <= WIDEST else some @ x[:n].T >= low
        found[:n] |= found[:n].T
        found[np.arange(n), np.arange(n)] = False
        links = np.zeros(len(x), np.int64)
        for at in range(0, len(x), QUERIES):
            part = found[at:at + QUERIES] & (before[at:at + QUERIES] @ before[:n].T == 0)
            links[at:at + QUERIES] = part @ weight[:n]
        # Smallest id that each vector reaches inside the shard.
        label = np.arange(len(x))
        todo = np.ones(len(x), bool)
        for i in range(len(x)):
            if todo[i]:
                front = np.array([i])
                while len(front):
                    todo[front], label[front] = False, i
                    nodes = front[front < n]
                    near = np.append(found[:, nodes].any(1).nonzero()[0], found[front].any(0).nonzero()[0])
                    front = np.unique(near[todo[near]])
        least = {}
        for i, own in enumerate(label.tolist()):
            least[own] = min(ids[i], least.get(own, ids[i]))
        return rows[["id"]].assign(links=links, label=[least[v] for v in label.tolist()])

    return run


def _classes(vectors, id, vector):
    """All rows with two hashes of their vector, null where it cannot link."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        v, lambda x: x != 0)
    v = F.when(F.coalesce(fine, F.lit(False)) & F.col(f"`{id}`").isNotNull(), F.transform(v, lambda x: x + 0.0))
    rows = vectors.select(F.col(f"`{id}`").alias("id"), v.alias("v"))
    k1, k2 = F.xxhash64("v", F.size("v")), F.hash("v")
    return rows.select("id", "v", F.when(F.col("v").isNotNull(), k1).alias("k1"), F.when(F.col("v").isNotNull(), k2).alias("k2"))


def _found(classes, centroids, margin, low, kind):
    """(id, links, label) summed over shards: links to other classes, and one row per shard for the labels."""
    def assign(batches):
        apart = {}  # by vector length, once per task
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                column = part.column(1)
                x = unit(column.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                d = x.shape[1]
                if d not in apart:
                    apart[d] = distances(centroids[d])
                near = memberships(x, centroids[d], margin, apart[d])
                offsets = pa.array(np.append(0, near.sum(1).cumsum()).astype(np.int32))
                cells = pa.ListArray.from_arrays(offsets, pa.array(near.nonzero()[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], names=["id", "v", "w", "d", "cells"])

    # One length of vector per batch: rows are grouped by it first where there are several.
    if len(centroids) > 1:
        assigned = None
        for d in centroids:
            one = classes.where(F.col("d") == d).mapInArrow(assign, f"id {kind}, v array<double>, w long, d int, cells array<int>")
            assigned = one if assigned is None else assigned.union(one)
    else:
        assigned = classes.mapInArrow(assign, f"id {kind}, v array<double>, w long, d int, cells array<int>")
    assigned = durable(assigned)
    placed = assigned.withColumn("cell", F.explode("cells"))
    sizes = durable(placed.groupBy("d", "cell").agg(F.ceil(F.count("*") / PART).alias("parts")))
    placed = placed.join(F.broadcast(sizes), ["d", "cell"])  # at most MOST_CELLS rows per vector length
    nodes = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    graph = durable(nodes.select("d", "cell", "part", "id", "v").groupBy("d", "cell", "part").applyInPandas(
        _build, f"id {kind}, neighbours array<{kind}>"))
    united = durable(graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")))
    # Each part's nodes meet the queries of one part at a time: their own, or another's.
    own, all_parts = F.pmod(F.xxhash64("id"), F.col("parts")), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    roles = F.explode(F.concat(
        F.transform(all_parts, lambda p: F.struct(own.alias("part"), p.alias("run"), F.lit(True).alias("node"))),
        F.transform(F.filter(all_parts, lambda p: p != own), lambda p: F.struct(
            p.alias("part"), own.alias("run"), F.lit(False).alias("node")))))
    asked = placed.join(united, "id").withColumn("role", roles).select(
        "d", "cell", "role.*", "id", "v", "w", "cells", "neighbours")
    return durable(asked.groupBy("d", "cell", "part", "run").applyInPandas(_search(low), f"id {kind}, links long, label {kind}"))


def near_duplicates(vectors: DataFrame, id="vec_id", vector="embedding", low=0.95, margin=MARGIN) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of `vectors`; see the module's text."""
    rows = durable(_classes(vectors, id, vector))
    kind = rows.schema["id"].dataType.simpleString()
    classes = durable(rows.where("k1 is not null").groupBy("k1", "k2", "v").agg(F.min("id").alias("id"), F.count("*").alias("w")))
    flat = classes.select("id", "v", "w", F.size("v").alias("d"))
    centroids = {}
    for d, n in sorted(tuple(r) for r in flat.groupBy("d").count().collect()):
        most = max(1, min(SAMPLE, SAMPLE_VALUES // d))
        sample = flat.where(F.col("d") == d).orderBy(F.xxhash64("id"), "id").limit(most).select("v").toArrow()["v"]
        x = unit(sample.combine_chunks().flatten().to_numpy().reshape(len(sample), d))
        centroids[d] = fit_centroids(x, max(1, min(MOST_CELLS, len(x), n // CELL)))
    found = labels = None
    widest = ((2 - 2 * low) ** 0.5) / 2
    for border in (margin, widest) if margin < widest else (margin,):
        if not centroids:
            break
        found = _found(flat, centroids, border, low, kind)
        sums = durable(found.groupBy("id").agg(F.sum("links").alias("links")))
        if border >= widest or audit(flat, sums, low) >= FLOOR:
            break
    if found is not None:
        labels = durable(connected_components(found.select(F.col("id").alias("a"), F.col("label").alias("b"))))
        per_class = durable(classes.select("k1", "k2", "id", "w").join(sums, "id").join(labels, "id", "left").select(
            "k1", "k2", (F.col("links") + F.col("w") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")))
    else:
        per_class = rows.select("k1", "k2", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")).limit(0)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select("id", "k1", "k2").join(per_class, ["k1", "k2"], "left").select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def audit(flat, sums, low, most=AUDITED):
    """Mean share of its links that `sums` has for a bounded set of classes, by comparing them with all vectors in blocks.

    Classes without links do not count, and classes that link with each other share one vote.
    """
    picked = flat.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(most).select("id", "v", "w").toArrow()
    queries = {}
    for i, v in enumerate(picked["v"].to_pylist()):
        queries.setdefault(len(v), []).append((i, v))
    queries = {d: (np.array([i for i, _ in own]), unit([v for _, v in own])) for d, own in queries.items()}

    def compare(batches):
        total = np.zeros(most, np.int64)
        for batch in batches:
            for v, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(v) in queries:
                    at, x = queries[len(v)]
                    total[at] += (x @ unit([v])[0] >= low) * w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(most)), pa.array(total)], names=["i", "n"])

    truth = dict(flat.select("v", "w").mapInArrow(compare, "i long, n long").groupBy("i").agg(F.sum("n")).collect())
    ids = picked["id"].to_pylist()
    got = {r[0]: r[1] for r in sums.where(F.col("id").isin(ids)).collect()}
    share, votes = 0.0, 0.0
    weights = picked["w"].to_pylist()
    for at, x in queries.values():
        alike = np.maximum((x @ x.T >= low).sum(1), 1)
        for i, others in zip(at.tolist(), alike.tolist()):
            true = truth[i] - weights[i]
            if true > 0:
                share += min(got.get(ids[i], 0) / true, 1.0) / others
                votes += 1 / others
    return share / votes if votes else 1.0
