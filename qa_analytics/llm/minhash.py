"""Near-duplicate documents by one-permutation hashing.

A document's set holds the distinct shingles of `words` words (A-Z in lower
case); a text with fewer words is one shingle, a text without words (or null)
has no shingle and links with nothing. Two documents link if
`100 * intersection >= percent * union`.

Method: one permutation puts every shingle hash into one of bands x rows bins
and each bin keeps its smallest hash; empty bins borrow from a bin found by
their own random order over all bins (optimal densification). Documents that
agree in a whole band share a bucket. Equal sets are one class from the start,
with the smallest id as representative. In each bucket the representative with
the most company in all its buckets (an original rather than one of its
copies) is compared with the others: a star. Links are confirmed on the full
sets. Where a bucket still holds several components, the members outside its
largest one are compared with all others, so every two members of a bucket end
in one component or are compared. Buckets with one largest component are one
group, so that members which share many buckets meet once, not in each. The
comparison is exact and on full sets, but a set is held as what it has besides
the shingles of most sets of the group and what it lacks of them; an index from
each such difference to the sets that have it counts what a member shares with
all others. Near copies and pages of one template differ in little, and little
of that is common, so a comparison costs some nanoseconds.

Sizes: signatures and buckets are tables; nothing is collected. A hot set is
one class; the pairs of a hot centre are dealt to slots with a copy of its
set in each; a hot group is cut into blocks of about `BLOCK` shingles, and each
block of members outside meets each block of the group in a task of its own.

Defined cases: a null id is never linked (component null, kept true); rows
that repeat an id are one document for the purpose of links; ties go to the
smallest id; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import DataFrame, functions as F

from ..session import durable, released
from .common import own
from .components import connected_components

BANDS, ROWS = 42, 6
SHARE, BLOCK = 256, 1 << 21
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x):
    """A bijective scramble of 64-bit numbers (arrays wrap around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: The six ASCII white-space characters.
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes of a word that is hashed alone.
LONG = 128


def word_hashes(text: bytes):
    """(starts, hashes) of the words of a text, A-Z in lower case: eight bytes of all words at a time."""
    text = text.lower()
    chars = np.frombuffer(text + b" " * (16 - len(text) % 8), np.uint8)
    space = SPACES[chars]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]
    eights, sizes = chars.view("<u8"), ends - starts
    h = sizes.astype(np.uint64)
    for i in np.flatnonzero(sizes > LONG):
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i]:ends[i]])
    some = np.flatnonzero(sizes <= LONG)
    at, left = starts[some], sizes[some]
    while len(at):
        shift, place = (at & 7).astype(np.uint64) << np.uint64(3), at >> 3
        # Eight bytes from any place are of two neighbours; the second moves in two steps, as 64 at once is undefined.
        part = (eights[place] >> shift) | (eights[place + 1] << np.uint64(1) << (np.uint64(63) - shift))
        over = np.maximum(8 - left, 0).astype(np.uint64) << np.uint64(3)
        h[some] = mix(h[some] * MIX + (part << over))
        more = np.flatnonzero(left > 8)
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return starts, h


def shingle_sets(texts, k):
    """For each text the sorted distinct hashes of its k-word shingles; texts are hashed some at a time."""
    held, n = [], 0
    for text in texts:
        held.append(text or b"")
        n += len(held[-1]) + 1
        if n > 1 << 19:
            yield from _sets_of(held, k)
            held, n = [], 0
    if held:
        yield from _sets_of(held, k)


def _sets_of(texts, k):
    # The end of a text is that of its last word, whose next word starts behind the separator.
    starts, h = word_hashes(b" ".join(texts))
    ends = np.searchsorted(starts, np.fromiter(map(len, texts), np.int64, len(texts)).cumsum() + np.arange(1, len(texts) + 1))
    whole = _shingles(h, k)
    begin = 0
    for end in ends.tolist():
        size = end - begin
        found = np.sort(whole[begin:end - k + 1] if size >= k else _shingles(h[begin:end], size))
        yield found[np.append(True, found[1:] != found[:-1])] if len(found) else found
        begin = end


def _shingles(h, k):
    """Hashes of all runs of k words; none of no word."""
    if not 0 < k <= len(h):
        return np.empty(0, np.uint64)
    z = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        z = mix(z * MIX + h[i:len(h) - k + 1 + i])
    return z


def bin_orders(bins):
    """For each bin a random order over all bins, the same in every task."""
    rng = np.random.RandomState(20240101)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def bin_bounds(bins):
    return np.array([(i << 64) // bins for i in range(bins)], dtype=np.uint64)


def densified(hashes, bounds, orders):
    """Smallest hash of every bin; an empty bin takes that of the first filled bin in its order."""
    first = np.searchsorted(hashes, bounds)
    filled = first < np.append(first[1:], len(hashes))
    values = hashes[np.minimum(first, len(hashes) - 1)]
    empty = np.flatnonzero(~filled)
    # Most find a filled bin among the first few.
    for width in (16, None):
        rows = orders[empty, :width]
        at = filled[rows].argmax(1) if len(empty) else empty
        taken = rows[np.arange(len(empty)), at]
        known = filled[taken]
        values[empty[known]] = values[taken[known]]
        empty = empty[~known]
        if not len(empty):
            break
    return values


def _texts(column):
    return column.cast(pa.binary()).to_pylist()


def _signer(k, bands, rows):
    def sign(batches):
        bounds, orders = bin_bounds(bands * rows), bin_orders(bands * rows)
        seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * MIX)
        for batch in batches:
            ids, sizes, k1, k2, at, mins = batch.column(0), [], [], [], [], []
            for i, found in enumerate(shingle_sets(_texts(batch.column(1)), k)):
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                k1.append((digest >> 64) - (1 << 63))
                k2.append((digest & (1 << 64) - 1) - (1 << 63))
                if len(found):
                    at.append(i)
                    mins.append(densified(found, bounds, orders))
            keys = np.zeros((len(sizes), 0), np.int64)
            lists = [[]] * len(sizes)
            if mins:
                m = np.stack(mins).reshape(len(mins), bands, rows)
                z = np.broadcast_to(seeds, m.shape[:2]).copy()
                for r in range(rows):
                    z = mix(z * MIX + m[:, :, r])
                keys = z.view(np.int64)
                offsets = np.zeros(len(sizes) + 1, np.int32)
                offsets[np.array(at) + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(offsets.cumsum().astype(np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 lists if mins else pa.array(lists, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "k1", "k2", "bands"])

    return sign


def _hasher(k):
    def run(batches):
        for batch in batches:
            held, since, n = [], 0, 0
            for i, found in enumerate(shingle_sets(_texts(batch.column(1)), k)):
                held.append(found)
                n += len(found)
                # Some megabytes at a time, so that long texts do not pile up.
                if n > 1 << 19 or i + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *map(len, held)], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(since, len(held)),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(held).view(np.int64)))],
                        names=["id", "hashes"])
                    held, since, n = [], i + 1, 0

    return run


def hash_sets(docs, k):
    """(id, hashes): the full shingle set of each row of `docs`."""
    return docs.select("id", "text").mapInArrow(
        _hasher(k), f"id {docs.schema['id'].dataType.simpleString()}, hashes array<bigint>")


def common_sizes(batches):
    """(a, b, both, sum): sizes of the intersection of two sorted sets and of both sets, pair by pair.

    The smaller set is looked up in the larger one.
    """
    for batch in batches:
        sides = []
        for column in (batch.column(2), batch.column(3)):
            sides.append((column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()))
        (x, x_at), (y, y_at) = sides
        both = np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            few, many = x[x_at[i]:x_at[i + 1]], y[y_at[i]:y_at[i + 1]]
            if len(few) > len(many):
                few, many = many, few
            if len(few):
                # "clip": the place after the end becomes the last one, which is unequal.
                both[i] = np.count_nonzero(many.take(many.searchsorted(few), mode="clip") == few)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(both), pa.array(np.diff(x_at) + np.diff(y_at), pa.int64())],
            names=["a", "b", "both", "sum"])


def _dealt(sets, pairs, side, slot):
    """Sets by (id, slot): each once, and once more for every further slot in which the id of `side` has pairs."""
    more = durable(pairs.where(F.col(slot) > 0).select(F.col(side).alias("id"), slot).distinct())
    return sets.withColumn(slot, F.lit(0)).unionByName(sets.join(more, "id")).withColumnRenamed("id", side)


def compared(pairs, sets):
    """(a, b, both, either): sizes of the intersection and the union of the full sets of each pair (a, b, n).

    `n` says how many partners an end may have. The pairs of an end with many are dealt to one slot for every `SHARE`
    of them, and its set travels once to each slot, so that a hot centre is not one task.
    """
    sets = sets.select("id", "hashes")
    slots = F.greatest(F.ceil(F.col("n") / SHARE), F.lit(1))
    pairs = durable(pairs.select("a", "b", *(
        F.pmod(F.xxhash64(other), slots).cast("int").alias(slot) for slot, other in (("of_a", "b"), ("of_b", "a")))))
    with_b = pairs.join(_dealt(sets, pairs, "b", "of_b").withColumnRenamed("hashes", "set_b"), ["b", "of_b"])
    with_a = with_b.join(_dealt(sets, pairs, "a", "of_a").withColumnRenamed("hashes", "set_a"), ["a", "of_a"])
    kind = pairs.schema["a"].dataType.simpleString()
    out = with_a.select("a", "b", "set_a", "set_b").mapInArrow(common_sizes, f"a {kind}, b {kind}, both long, sum long")
    out = out.withColumn("either", F.col("sum") - F.col("both"))
    # An id with several texts counts by the pair of them that is most alike.
    most = F.max(F.struct((F.col("both") / F.col("either")).alias("share"), "both", "either")).alias("m")
    return out.groupBy("a", "b").agg(most).select("a", "b", "m.both", "m.either")


def outside_links(sets, sizes, components, outside, met, percent):
    """(rows, partners) that link rows marked `outside` with rows marked `met` of other components.

    `sets` holds the hashes of all rows one after the other. Of the links between two components, or what became of
    them by links before, one is returned.
    """
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    _, code, held_by = np.unique(sets, return_inverse=True, return_counts=True)
    # What most rows hold; a row is known by what it lacks of that and by what else it holds.
    most = held_by * 2 > n
    frequent = np.flatnonzero(most)
    is_frequent = most[code]
    has = np.zeros((n, len(frequent)), bool)
    has[row[is_frequent], np.searchsorted(frequent, code[is_frequent])] = True
    lacks, what = np.nonzero(~has)
    lacking = len(frequent) - has.sum(1)
    row, code = np.concatenate([row[~is_frequent], lacks]), np.concatenate([code[~is_frequent], frequent[what]])
    kept = (np.bincount(code, minlength=len(most)) > 1)[code]
    row, code = row[kept], code[kept]
    order = np.argsort(row, kind="stable")
    of_row, row_at = code[order], np.append(0, np.bincount(row, minlength=n).cumsum())
    row, code = row[met[row]], code[met[row]]
    holders, counts = row[np.argsort(code, kind="stable")], np.bincount(code, minlength=len(most))
    starts = counts.cumsum() - counts
    labels, rows, partners = np.unique(components, return_inverse=True)[1], [], []
    for x in np.flatnonzero(outside):
        own = of_row[row_at[x]:row_at[x + 1]]
        each = counts[own]
        ends = each.cumsum()
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[own] - (ends - each), each)
        both = np.bincount(holders[places], minlength=n) + (len(frequent) - lacking[x]) - lacking
        linked = (both > 0) & (100 * both >= percent * (sizes[x] + sizes - both))
        found = np.flatnonzero(linked & met & (labels != labels[x]))
        if len(found):
            reached, first = np.unique(labels[found], return_index=True)
            rows += [x] * len(first)
            partners += found[first].tolist()
            labels[np.isin(labels, reached)] = labels[x]
    return np.array(rows, np.int64), np.array(partners, np.int64)


def residual_links(inside, sets, percent):
    """Links (a, b) of members outside the largest component of their buckets with members of other components.

    `inside` has a row (most, id, size, component, outside) for each member of a group, the buckets whose largest
    component is `most`. Members are dealt to blocks; every block of members outside meets every block of the group.
    """
    kind = sets.schema["id"].dataType.simpleString()
    blocks = lambda size: F.greatest(F.ceil(F.sum(size) / BLOCK), F.lit(1)).cast("int")
    groups = inside.groupBy("most").agg(
        F.max("outside").alias("any"), blocks(F.when(F.col("outside"), F.col("size")).otherwise(0)).alias("p"),
        blocks(F.col("size")).alias("q")).where("any").drop("any")
    place = lambda of, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(of)).cast("int")
    dealt = inside.join(groups, "most").select(
        "id", "outside", "p", "q", F.xxhash64("most").alias("of"), F.xxhash64("component").alias("component"),
        place("p", 1).alias("own_p"), place("q", 2).alias("own_q"))
    one = lambda p, q, out, met: F.struct(p.alias("p"), q.alias("q"), out.alias("out"), met.alias("met"))
    p, q, out = F.col("own_p"), F.col("own_q"), F.col("outside")
    asking = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: one(p, j, F.lit(True), j == q))
    asked = F.transform(F.filter(F.sequence(F.lit(0), F.col("p") - 1), lambda i: ~out | (i != p)), lambda i: one(
        i, q, F.lit(False), F.lit(True)))
    dealt = dealt.select("id", "of", "component", F.explode(F.when(out, F.concat(asking, asked)).otherwise(asked)).alias("b"))
    # The hint spares a sort of the sets.
    held = sets.join(dealt.select("id", "of", "component", "b.*").hint("shuffle_hash"), "id")

    def links(table):
        hashes = table.column("hashes").combine_chunks()
        columns = (table.column(c).to_numpy() for c in ("component", "out", "met"))
        sizes = hashes.value_lengths().to_numpy().astype(np.int64)
        ends = outside_links(hashes.flatten().to_numpy(), sizes, *columns, percent)
        return pa.Table.from_arrays([table.column("id").take(pa.array(x)) for x in ends], names=["a", "b"])

    return held.groupBy("of", "p", "q").applyInArrow(links, f"a {kind}, b {kind}")


def _star_links(members, docs, k, percent):
    """(id, component) for all linked ids; `members` has the (key, id, size) rows of buckets with company."""
    company = durable(members.groupBy("id").agg(F.sum("n").alias("score")))
    # One kind of join at every size wherever texts meet ids: the ids are hashed, and texts are moved once and not sorted.
    sets = durable(hash_sets(docs.join(company.hint("shuffle_hash"), "id", "left_semi"), k))
    open_ = members.join(company, "id").select("key", "id", "size", "score", "n")
    best = F.max(F.struct("score", "id", "size"))
    centres = durable(open_.groupBy("key").agg(best.alias("c")).select(
        "key", F.col("c.id").alias("c_id"), F.col("c.size").alias("c_size")))
    open_ = durable(open_.join(centres, "key").withColumns({
        "a": F.least("id", "c_id"), "b": F.greatest("id", "c_id"),
        "alike": 100 * F.least("size", "c_size") >= percent * F.greatest("size", "c_size")}))
    tested = durable(compared(open_.where("alike and id != c_id").groupBy("a", "b").agg(F.max("n").alias("n")), sets))
    links_of = lambda pairs: pairs.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")
    components = _merged(None, links_of(tested))
    marked = durable(open_.join(components, "id", "left").select(
        "key", "id", "size", "n", (F.col("id") == F.col("c_id")).alias("served"),
        F.coalesce("component", "id").alias("component")))
    # Only buckets with several components stay open; of two members, one is the centre.
    largest = durable(marked.where("n > 2").groupBy("key", "component").agg(F.count("*").alias("members")).groupBy("key").agg(
        F.max(F.struct("members", "component")).alias("most"), F.count("*").alias("parts")).where("parts > 1").select(
        "key", F.col("most.component").alias("most")))
    inside = durable(marked.join(largest, "key").groupBy("most", "id").agg(
        F.max("size").alias("size"), F.max("component").alias("component"),
        F.max(F.expr("component != most and not served")).alias("outside")))
    return _merged(components, residual_links(inside, sets, percent))


def _merged(components, links):
    """Component labels after more links."""
    if components is None:
        return durable(connected_components(links))
    links = durable(links)
    if links.isEmpty():
        return components
    ends = links.join(components.withColumnRenamed("id", "a").withColumnRenamed("component", "ca"), "a", "left").join(
        components.withColumnRenamed("id", "b").withColumnRenamed("component", "cb"), "b", "left")
    moves = durable(connected_components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))))
    moved = components.join(moves.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    return durable(moved.select("id", F.coalesce("to", "component").alias("component")).union(
        moves.join(components, "id", "left_anti")))


def near_duplicates(docs: DataFrame, id="doc_id", text="text", words=5, percent=80, bands=BANDS, rows=ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of `docs`; see the module's text."""
    docs = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def classified():
        signed = durable(docs.mapInArrow(
            _signer(words, bands, rows), f"id {kind}, n_shingles long, k1 long, k2 long, bands array<bigint>"))
        full = signed.where("id is not null and n_shingles > 0")
        classes = durable(full.groupBy("k1", "k2", "n_shingles").agg(F.min("id").alias("rep")))
        reps = full.join(classes.select(F.col("rep").alias("id"), "k1", "k2"), ["id", "k1", "k2"], "left_semi")
        reps = reps.select("id", F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
        buckets = durable(reps.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        members = durable(reps.join(buckets, "key").distinct())
        components, = released(docs.sparkSession, lambda: (_star_links(members, docs, words, percent),))
        component = classes.join(components.withColumnRenamed("id", "rep"), "rep", "left").select(
            "k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component"))
        return signed.select("id", "n_shingles", "k1", "k2"), component

    # Signatures, sets and pairs are gone when the classes are known.
    signed, component = released(docs.sparkSession, classified)
    out = signed.join(component, ["k1", "k2", "n_shingles"], "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id), "n_shingles", comp.alias("component_id"),
        F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def without_duplicates(docs: DataFrame, id="doc_id", text="text", **options) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    A document is an id with a text, so unlike texts of one id stay side by side; rows that agree in both are one. Rows
    without an id link with nothing, but of those with the same text one stays.
    """
    key = own("row_key", docs)
    keyed = docs.withColumn(key, F.struct(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h")))
    named, nameless = (keyed.where(x) for x in (F.col(f"`{id}`").isNotNull(), F.col(f"`{id}`").isNull()))
    kept, = released(docs.sparkSession, lambda: (
        near_duplicates(named, key, text, **options).where("kept").groupBy(key).count(),))
    single, several = (
        named.join(kept.where(x).select(key).hint("shuffle_hash"), key, "left_semi") for x in ("count = 1", "count > 1"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Of rows that are one document, which stays is up to a hash of their columns.
    order = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().count("map<")))
    once = several.unionByName(nameless).groupBy(key, F.hash(F.col(f"`{text}`"))).agg(
        F.min_by(F.struct(*columns), order).alias(key + "_row")).select(f"{key}_row.*")
    return single.select(*columns).unionByName(once)
