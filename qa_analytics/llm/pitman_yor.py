"""Language-model scores from a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Tokens are the words (A-Z in lower case) and one end per text. Every token is a
customer of the restaurant of its context, the word before it (or the start);
all context restaurants share one parent, whose customers are their tables, and
the parent's base is uniform over the known words and one unknown. The most
frequent words (at most `NEAR`) are known by a number, all others by a 64-bit
hash.

Training: a pass over the training texts counts words, another one (word,
context). Pairs are dealt to parts of about `PART` tokens, by the hash of the
word or context that has no number, if there is one; a row holds all pairs of a
part as bytes. Sums of numbered words are arrays, those of others tables, so
nothing is bounded by a number of contexts. What the numbered words share is sent to every task; pairs with
another word are joined with the tables. A word met once has one customer and
one table in the parent for good, and a context of pairs met once as many
tables as customers: neither is drawn or written again. A Gibbs sweep
draws the number of tables of each dish in each restaurant given all other
dishes: from its exact distribution (generalised Stirling numbers) up to
`EXACT` customers; above that the first ones are drawn so, with the weight of
all that follow, and the tables opened later are a negative binomial number
(the law's limit in continuous time). A pair seen once has one table
and is not drawn. Draws are a function of the pair, the sweep and the totals
before it. Predictive probabilities are averaged over the sweeps after the
first ones.

Scoring: every task adds up the probabilities of tokens of two numbered words,
with the share of the pair if it is one of the most frequent (a fixed number of
pairs), else as if the pair had not been met. The other tokens go to the parts of
their pairs, words and contexts, packed by block of texts, and what they add
comes back as sums per text; tokens of two words without a number first pass by
the part of the context. Parts are taken in `ROUNDS`, one after the other, so
that the shuffle files of one are gone before the next is read. The result does not depend on which words and pairs are
frequent, nor on the parts.

Discounts come from counts of counts, the strength is a parameter. Null text is
empty: just an end. Null ids count as empty text when training texts are
chosen. Repeated rows are trained on and scored each. An empty table gives no
row, and an empty training set makes every token unknown. Other columns are
ignored.
"""

from collections import namedtuple
from functools import reduce
from itertools import chain
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from pyspark.sql import DataFrame, functions as F

from ..session import cleaned, durable, remove, staging_path
from .minhash import MIX, mix

FREQUENT_PAIRS = 500_000
NEAR = 1 << 18
PART = 1_000_000
ROUNDS = 3
BURN_IN, SAMPLES = 1, 3
STRENGTH = 1.0
EXACT = 64
GROUP = 256
END = b""


def _coder(near):
    """From hashes of words to their codes: the place in `near`, else the hash."""
    order = np.argsort(near)
    known = near[order]

    def codes(hashes):
        code = hashes.view(np.int64)
        if len(known):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            code = np.where(known[place] == hashes, order[place], code)
        return code

    return codes


def _groups(batches, most=1 << 22):
    """The rows of a task in groups of about so many bytes."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP):
            held.append(batch.slice(at, GROUP))
            size += held[-1].nbytes
            if size > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _tokens(texts):
    """Hashes of the distinct words; (word number, number of the word before, text number) of every token.

    Number 0 is the end, and as a word before the start.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    encoded = lists.flatten().dictionary_encode()
    distinct = len(encoded.dictionary)
    _, offsets, letters = encoded.dictionary.buffers()
    ends = np.frombuffer(offsets, np.int32)[:distinct + 1] if distinct else np.zeros(1, np.int32)
    letters = letters.to_pybytes() if letters else b""
    words = map(letters.__getitem__, map(slice, ends[:-1].tolist(), ends[1:].tolist()))
    hashes = np.fromiter(chain([xxhash.xxh3_64_intdigest(END)], map(xxhash.xxh3_64_intdigest, words)), np.uint64, distinct + 1)
    number = encoded.indices.to_numpy().astype(np.int64) + 1
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    full = (np.diff(ends) > 0)[number - 1]
    if not full.all():  # white space at an end of the text
        number, text = number[full], text[full]
    sizes = np.bincount(text, minlength=len(texts)) + 1
    numbers = np.zeros(sizes.sum(), np.int64)
    inside = np.ones(len(numbers), bool)
    inside[np.cumsum(sizes) - 1] = False
    numbers[inside] = number
    return hashes, numbers, np.append(0, numbers[:-1]), np.repeat(np.arange(len(sizes)), sizes)


def _is_near(column, facts):
    return (F.col(column) >= 0) & (F.col(column) < facts["near"])


# ---- parts ------------------------------------------------------------------

# What goes to the part of a key: one row per part and kind, with the values of all its keys as bytes.
NEAR_PAIR, FAR_PAIR, WORD, CONTEXT, ASK_NEAR, ASK_FAR, ASK_BOTH, ASK_MET = range(8)
PACKED = "part int, kind int, block long, a binary, b binary, d binary, v binary"


def _n_parts(tokens, near):
    """About one for `PART` training tokens; no divisor in common with `near`, so that codes of pairs spread over them."""
    parts = max(17, (near * near >> 32) + 1, tokens // PART)
    while gcd(parts, max(near, 1)) > 1:
        parts += 1
    return parts


def _part_of(codes, parts):
    return (mix(codes.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _pair_hash(h, ctx):
    return mix(mix(h.view(np.uint64)) * MIX + ctx.view(np.uint64))


def _home(h, ctx, near, parts):
    """The part of a pair with a word that has no number: that of the word, else that of the context."""
    return _part_of(np.where((h >= 0) & (h < near), ctx, h), parts)


def _packed(kind, part, block=None, **columns):
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    rows = len(starts)
    full = [pa.array(part[starts].astype(np.int32)), pa.array(np.full(rows, kind, np.int32)), pa.array([block] * rows, pa.int64())]
    for name in "abdv":
        if name in columns:
            values = np.ascontiguousarray(columns[name][order])
            ends = np.append(starts, len(part)) * (values.nbytes // max(len(values), 1))
            full.append(pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())]))
        else:
            full.append(pa.nulls(rows, pa.binary()))
    return pa.RecordBatch.from_arrays(full, names=["part", "kind", "block", "a", "b", "d", "v"])


def _packed_pairs(h, ctx, values, near, parts):
    close = (h >= 0) & (h < near) & (ctx >= 0) & (ctx < near)
    if close.any():
        rest, part = np.divmod(ctx[close] * near + h[close], parts)
        yield _packed(NEAR_PAIR, part, a=rest.astype(np.uint32), v=values[close])
    if not close.all():
        h, ctx, values = h[~close], ctx[~close], values[~close]
        yield _packed(FAR_PAIR, _home(h, ctx, near, parts), a=h, b=ctx, v=values)


def _values(rows, column, kind):
    return np.frombuffer(b"".join(rows[column].to_pylist()), kind)


def _of_kind(rows, kind):
    return rows.filter(pc.equal(rows["kind"], kind))


def _pairs_in(row, near, parts, values=np.int64):
    """(h, ctx, values) of a row of pairs."""
    v = np.frombuffer(row["v"], values)
    if row["kind"] == FAR_PAIR:
        return np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64), v
    ctx, h = np.divmod(np.frombuffer(row["a"], np.uint32).astype(np.int64) * parts + row["part"], near)
    return h, ctx, v


def _rows_of(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _merged(key, rows):
    """One row per kind for the pairs of a part, with their counts added up."""
    part, out = key[0].as_py(), []
    near, far = (_of_kind(rows, kind) for kind in (NEAR_PAIR, FAR_PAIR))
    if near.num_rows:
        a, where = np.unique(_values(near, "a", np.uint32), return_inverse=True)
        counts = np.bincount(where, _values(near, "v", np.int64)).astype(np.int64)
        out.append(_packed(NEAR_PAIR, np.full(len(a), part), a=a, v=counts))
    if far.num_rows:
        h, ctx = _values(far, "a", np.int64), _values(far, "b", np.int64)
        _, first, where = np.unique(_pair_hash(h, ctx), return_index=True, return_inverse=True)
        counts = np.bincount(where, _values(far, "v", np.int64)).astype(np.int64)
        out.append(_packed(FAR_PAIR, np.full(len(first), part), a=h[first], b=ctx[first], v=counts))
    return pa.Table.from_batches(out)


def _sums_by_number(sums, slices=16):
    """Sums of the numbered words of a task as bytes, in slices that are added up apart."""
    split = [x.tobytes() for x in np.array_split(sums, slices, axis=1)]
    return pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array(split, pa.binary())], names=["slice", "v"])


def _added(key, rows):
    total = sum(np.frombuffer(x, np.int64) for x in rows["v"].to_pylist())
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})


def _summed_by_number(df, run, n, near):
    """`n` sums for each numbered word, as arrays."""
    rows = df.mapInArrow(run, "slice int, v binary").groupBy("slice").applyInArrow(_added, "slice int, v binary").collect()
    sums = [np.frombuffer(x.v, np.int64).reshape(n, -1) for x in sorted(rows)]
    return np.concatenate(sums, axis=1) if sums else np.zeros((n, near), np.int64)


def _near_totals(near, parts):
    """Customers, pairs met once, pairs met twice and pairs of every numbered word (4 sums), then of its context."""
    def run(batches):
        sums = np.zeros((8, near), np.int64)
        for row in _rows_of(batches):
            *sides, c = _pairs_in(row, near, parts)
            for side, key in enumerate(sides):
                at = np.flatnonzero((key >= 0) & (key < near))
                for i, x in enumerate((c, c == 1, c == 2, None)):
                    sums[4 * side + i] += np.bincount(key[at], None if x is None else x[at], near).astype(np.int64)
        yield _sums_by_number(sums)

    return run


def _far_totals(near, parts, side):
    """The same sums for the words (`side` 0) or contexts (1) without a number."""
    def run(batches):
        for row in _rows_of(batches):
            *sides, c = _pairs_in(row, near, parts)
            far = (sides[side] < 0) | (sides[side] >= near)
            key, where = np.unique(sides[side][far], return_inverse=True)
            sums = [np.bincount(where, x[far]).astype(np.int64) for x in (c, c == 1, c == 2, np.ones(len(c)))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, *sums)], names=["key", "c", "once", "twice", "n"])

    return run


def _unpacked(near, parts, once):
    """Pairs met once, or those met more often, as rows."""
    def run(batches):
        for row in _rows_of(batches):
            h, ctx, c = _pairs_in(row, near, parts)
            chosen = (c == 1) == once
            for at in range(0, max(chosen.sum(), 1), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[chosen][at:at + 100_000]) for x in (h, ctx, c)], names=["h", "ctx", "c"])

    return run


def _level(column):
    """Eighths of powers of two, so that counts have few levels."""
    return F.floor(F.log2(column) * 8)


def _lowest(df, column, most):
    """The lowest level down to which no more than `most` rows have a count."""
    lowest = None
    for level, n in sorted(df.groupBy(_level(column).alias("level")).count().collect(), reverse=True):
        most -= n
        if most < 0:
            break
        lowest = level
    return lowest


def _at_least(column, lowest):
    return F.lit(False) if lowest is None else _level(column) >= lowest


def _apart(column, facts):
    """A key to join the words without a number by; all others are spread over keys that meet nothing."""
    return F.when(_is_near(column, facts), -1 - F.pmod(F.xxhash64("h", "ctx"), F.lit(1 << 20))).otherwise(F.col(column))


def _by_number(df, key, facts, columns):
    """The columns of the numbered words as arrays, in the order of their numbers."""
    rows = df.where(_is_near(key, facts)).select(F.col(key), *columns).toArrow()
    at = rows[key].to_numpy()
    out = []
    for name in rows.column_names[1:]:
        values = rows[name].combine_chunks()
        if pa.types.is_list(values.type):
            values = values.flatten().to_numpy().reshape(len(at), facts["samples"])
        else:
            values = values.to_numpy(zero_copy_only=False)
        full = np.zeros((facts["near"], *values.shape[1:]), values.dtype)
        full[at] = values
        out.append(full)
    return out


# ---- seating ----------------------------------------------------------------

def stirling(most, discount):
    """log S(c, t), the weight of all ways to seat c customers of a dish at t tables, for c up to `most`."""
    log = np.full((most + 1, most + 1), -np.inf)
    log[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, c + 2)
        log[c + 1, 1:c + 2] = np.logaddexp(log[c, :c + 1], log[c, 1:c + 2] + np.log(np.maximum(c - t * discount, 1e-300)))
    return log


class Keyed:
    """Random numbers that belong to rows, whatever batch the rows are in."""

    def __init__(self, keys):
        self.keys, self.turn = keys, np.uint64(0)

    def of(self, rows):
        return Keyed(self.keys[rows])

    def gumbel(self, size):
        turns = self.turn + np.arange(1, size[1] + 1, dtype=np.uint64)
        self.turn += np.uint64(size[1])
        uniform = ((mix(mix(self.keys[:, None] + turns * MIX)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        return -np.log(-np.log(uniform))

    def negative_binomial(self, n, p):
        self.turn += np.uint64(1)
        seeds = mix(self.keys + self.turn * MIX).tolist()
        return np.array([np.random.Generator(np.random.PCG64(k)).negative_binomial(*x) for k, *x in zip(seeds, n, p)], np.int64)


def draw_tables(c, others, discount, strength, chance, rng, log):
    """Tables of dishes with `c` customers; `others`: tables of other dishes there, `chance`: the parent's probability.

    Beyond `EXACT` customers, what tables weigh in the seatings to come is a factor per table, and the tables opened by
    then are a linear birth process: a negative binomial number.
    """
    own = rng.of if isinstance(rng, Keyed) else lambda rows: rng
    t = np.ones(len(c), np.int64)
    large = c > EXACT
    # (first customers : all) ** discount; 1 where all seats are drawn exactly.
    part = np.where(large, ((EXACT - 0.5) / np.maximum(c - 0.5, EXACT - 0.5)) ** discount, 1.0)
    ahead = part / (chance * part + 1.0 - chance)
    first = np.minimum(c, EXACT)
    for n in np.unique(first[first > 1]):
        at = np.flatnonzero(first == n)
        opened = np.arange(n)
        steps = np.log(strength + discount * (others[at, None] + opened)) + np.log((chance * ahead)[at, None])
        weight = log[n, 1:n + 1] + np.cumsum(steps, axis=1)
        t[at] = 1 + np.argmax(weight + own(at).gumbel(size=weight.shape), axis=1)
    at = np.flatnonzero(large)
    if len(at):
        t[at] += own(at).negative_binomial(strength / discount + others[at] + t[at], 1.0 - chance[at] * (1.0 - part[at]))
    return t


def _discount(one, two):
    return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5


Tables = namedtuple("Tables", "pairs words contexts counted seats")

# Pairs met more often, with their tables: those of two numbered words packed by part, others as rows.
SEATS = "part int, a binary, cs binary, ts binary, shares binary, h long, ctx long, c long, t long, share double"
QUIET = "hs binary, cs binary, ns binary, at binary, parents binary, n long, served long"


def _word_counter(room=1_000_000):
    def merged(held):
        keys, where = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)

    def rows(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["h", "c"])

    def run(batches):
        held = []
        for batch in _groups(batches):
            hashes, numbers, _, _ = _tokens(batch.column(0))
            counts = np.bincount(numbers, minlength=len(hashes))
            held.append((hashes[counts > 0], counts[counts > 0]))
            if sum(len(x) for x, _ in held) > room:
                held = [merged(held)]
                if len(held[0][0]) > room // 2:
                    yield rows(*held.pop())
        if held:
            yield rows(*merged(held))

    return run


def _pair_counter(shared, parts):
    def run(batches):
        near = len(shared.value)
        codes = _coder(shared.value)
        for batch in _groups(batches):
            hashes, numbers, before, _ = _tokens(batch.column(0))
            code = codes(hashes)
            keys, counts = np.unique(numbers << 32 | before, return_counts=True)
            yield from _packed_pairs(code[keys >> 32], code[keys & 0xFFFFFFFF], counts.astype(np.int64), near, parts)

    return run


def _seat_batch(columns, rows):
    names = SEATS.replace(",", "").split()
    return pa.RecordBatch.from_arrays(
        [columns[x] if x in columns else pa.nulls(rows, {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "double": pa.float64()}[kind])
         for x, kind in zip(names[::2], names[1::2])], names=names[::2])


def _packed_seats(part, a, c, t, share):
    return _seat_batch({"part": pa.array([part], pa.int32()), **{
        name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("a", "cs", "ts", "shares"), (a, c, t, share))}}, 1)


def _seats_of(row, near, parts):
    """(codes in the part, h, ctx, customers, tables, shares) of a packed row."""
    a = np.frombuffer(row["a"], np.uint32)
    ctx, h = np.divmod(a.astype(np.int64) * parts + row["part"], near)
    return a, h, ctx, *(np.frombuffer(row[x], kind) for x, kind in (("cs", np.int64), ("ts", np.int64), ("shares", np.float64)))


def _first_seats(batches):
    for row in _rows_of(batches):
        c = np.frombuffer(row["v"], np.int64)
        if (c > 1).any():
            a, c = np.frombuffer(row["a"], np.uint32)[c > 1], c[c > 1]
            yield _packed_seats(row["part"], a, c, np.ones(len(c), np.int64), np.zeros(len(c)))


def _keys(codes, sweep, hashes):
    """Keys from the words' hashes, so that draws do not depend on which words are numbered."""
    key = np.full(len(codes[0]), sweep + 1, np.uint64)
    for code in codes:
        of = code.view(np.uint64).copy()
        _put(of, hashes, code)
        key = mix(key * MIX + of)
    return Keyed(key)


def _put(values, by_number, codes):
    """Sets the values of numbered words."""
    near = np.flatnonzero((codes >= 0) & (codes < len(by_number)))
    values[near] = by_number[codes[near]]


def _pair_seats(facts, sweep, kept, shared):
    """Pairs with new tables; what they leave to their own share is added up over the sweeps that are kept."""
    def drawn(h, ctx, c, t, share, chance, tables):
        hashes, (of_word, of_context) = facts["codes"].value, shared.value
        _put(chance, of_word, h)
        _put(tables, of_context, ctx)
        t = draw_tables(c, np.maximum(tables - t, 0), facts["d1"], facts["strength"], chance, _keys((h, ctx), sweep, hashes),
                        stirling(EXACT, facts["d1"]))
        return t, share + np.maximum(c - facts["d1"] * t, 0) if kept else share

    def close(batches):
        for row in _rows_of(batches):
            a, h, ctx, c, t, share = _seats_of(row, facts["near"], facts["parts"])
            t, share = drawn(h, ctx, c, t, share, np.zeros(len(h)), np.zeros(len(h), np.int64))
            yield _packed_seats(row["part"], a, c, t, share)

    def apart(batches):
        for batch in batches:
            h, ctx, c, t, share = (batch.column(x).to_numpy() for x in ("h", "ctx", "c", "t", "share"))
            joined = (batch.column(x).fill_null(0).to_numpy(zero_copy_only=False).copy() for x in ("chance", "tables"))
            t, share = drawn(h, ctx, c, t, share, *joined)
            yield _seat_batch({**{x: batch.column(x) for x in ("h", "ctx", "c")}, "t": pa.array(t), "share": pa.array(share)}, len(h))

    return close, apart


def _near_tables(near, parts):
    """Tables of drawn pairs for each numbered word, then for each numbered context."""
    def run(batches):
        sums = np.zeros((2, near), np.int64)

        def add(h, ctx, t):
            for total, key in zip(sums, (h, ctx)):
                at = np.flatnonzero((key >= 0) & (key < near))
                total += np.bincount(key[at], t[at], near).astype(np.int64)

        for batch in batches:
            packed = pc.is_valid(batch.column("part"))
            for row in _rows_of([batch.filter(packed)]):
                ctx, h = np.divmod(np.frombuffer(row["a"], np.uint32).astype(np.int64) * parts + row["part"], near)
                add(h, ctx, np.frombuffer(row["ts"], np.int64))
            apart = batch.filter(pc.invert(packed))
            add(*(apart.column(x).to_numpy() for x in ("h", "ctx", "t")))
        yield _sums_by_number(sums)

    return run


def _seat_rows(near, parts):
    """Packed pairs as rows."""
    def run(batches):
        for row in _rows_of(batches):
            _, h, ctx, c, _, share = _seats_of(row, near, parts)
            for at in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 100_000]) for x in (h, ctx, c, share)], names=["h", "ctx", "c", "share"])

    return run


def _quiet_batch(h, c, n, served, parents):
    return pa.RecordBatch.from_arrays(
        [*(pa.array([x.tobytes()], pa.binary()) for x in (h, c, n, served, parents)),
         pa.array([int(n.sum())], pa.int64()), pa.array([int(served.sum())], pa.int64())], names=["hs", "cs", "ns", "at", "parents", "n", "served"])


def _quiet(row):
    h, c, n, served = (np.frombuffer(row[x], np.int64) for x in ("hs", "cs", "ns", "at"))
    return h, c, n, served, np.frombuffer(row["parents"], np.float64).reshape(len(h), -1)


def _first_quiet(batches):
    for batch in batches:
        if batch.num_rows:
            h, c, n = (batch.column(x).to_numpy() for x in ("h", "c", "n"))
            yield _quiet_batch(h, c, n, np.ones(len(h), np.int64), np.zeros((len(h), 0)))


def _quiet_seats(facts, sweep, served_total, chance, kept):
    """Words whose pairs were all met once: only their tables in the parent are drawn."""
    def run(batches):
        log = stirling(EXACT, facts["d0"])
        for row in _rows_of(batches):
            h, c, n, served, parents = _quiet(row)
            if kept:
                parents = np.column_stack([parents, chance(n, served)])
            served = draw_tables(n, np.maximum(served_total - served, 0), facts["d0"], facts["strength"], np.full(len(n), 1.0 / (facts["V"] + 1)),
                                 _keys((h,), sweep, facts["codes"].value), log)
            yield _quiet_batch(h, c, n, served, parents)

    return run


def _quiet_rows(chance):
    """Rows of the model, with the probability after the last sweep."""
    def run(batches):
        for row in _rows_of(batches):
            h, c, n, served, parents = _quiet(row)
            parents = np.column_stack([parents, chance(n, served)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(c), pa.ListArray.from_arrays(np.arange(len(h) + 1, dtype=np.int32) * parents.shape[1], parents.ravel())],
                names=["h", "count", "parents"])

    return run


def _word_seats(facts, sweep, served_total):
    def run(batches):
        hashes, log = facts["codes"].value, stirling(EXACT, facts["d0"])
        for batch in batches:
            n, served = batch.column("n").to_numpy(), batch.column("served").to_numpy()
            base = np.full(len(n), 1.0 / (facts["V"] + 1))
            served = draw_tables(n, np.maximum(served_total - served, 0), facts["d0"], facts["strength"], base,
                                 _keys((batch.column("h").to_numpy(),), sweep, hashes), log)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("h", "c", "once", "n")), pa.array(served.astype(np.int64)), batch.column("parents")],
                names=["h", "c", "once", "n", "served", "parents"])

    return run


def train(texts: DataFrame, text="text", burn_in=BURN_IN, samples=SAMPLES, strength=STRENGTH, near=NEAR):
    """The model (`Tables`), and a dict of what all words share."""
    spark, texts = texts.sparkSession, texts.select(F.col(f"`{text}`"))
    met_at = staging_path(spark, "step")
    met = durable(texts.mapInArrow(_word_counter(), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), met_at)
    top = met.where(_at_least("c", _lowest(met, "c", near))).toArrow()
    names = top["h"].to_numpy()
    codes = spark.sparkContext.broadcast(names[np.lexsort((names, -top["c"].to_numpy()))].view(np.uint64))
    whole = met.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    remove(spark, met_at)
    near, parts = len(names), _n_parts(whole, len(names))
    facts = {"near": near, "parts": parts, "codes": codes, "strength": strength, "samples": samples, "unknown": []}
    counts = texts.mapInArrow(_pair_counter(codes, parts), PACKED)
    counted = durable(counts.groupBy("part").applyInArrow(_merged, PACKED), compression="zstd")
    del counts, met
    cleaned(spark)
    none = F.array().cast("array<double>")
    totals_at = staging_path(spark, "step"), staging_path(spark, "step")
    of_near = _summed_by_number(counted, _near_totals(near, parts), 8, near)
    of_word, of_context = (dict(zip(names, x)) for names, x in (
        (("c", "once", "twice", "n"), of_near[:4]), (("customers", "once", "twice", "tables"), of_near[4:])))
    far = counted.where(F.col("kind") == FAR_PAIR)
    sums = [far.mapInArrow(_far_totals(near, parts, side), "key long, c long, once long, twice long, n long") for side in (0, 1)]
    # All pairs of a word without a number are in its part; those of a context may be in other parts too.
    far_words = durable(sums[0].withColumnRenamed("key", "h"), totals_at[0])
    far_contexts = durable(sums[1].groupBy(F.col("key").alias("ctx")).agg(
        F.sum("c").alias("customers"), F.sum("once").alias("once"), F.sum("n").alias("tables")), totals_at[1])
    met = far_words.agg(*(F.coalesce(x, F.lit(0)) for x in (
        F.sum("once"), F.sum("twice"), F.sum("c"), F.count("*"), *(F.sum((F.col(x) == k).cast("long")) for x, k in (("n", 1), ("n", 2), ("c", 1)))))).first()
    once, twice, customers, distinct, n1, n2 = (a + int(b) for a, b in zip(met, (
        *(of_word[x].sum() for x in ("once", "twice", "c")), near, (of_word["n"] == 1).sum(), (of_word["n"] == 2).sum())))
    facts |= {"N": customers, "V": distinct, "d1": _discount(once, twice), "d0": _discount(n1, n2)}
    # Words met once and contexts of pairs met once keep their seats; numbered words are arrays here, at most `near` of them.
    d0, d1 = facts["d0"], facts["d1"]
    still, lone = met[6], []
    of_word |= {"served": np.ones(near, np.int64), "parents": []}
    of_context |= {"backs": []}
    quiet = far_words.where("c > 1 and once = n").select("h", "c", "n").mapInArrow(_first_quiet, QUIET)
    words = far_words.where("once < n").select("h", "c", "once", "n", F.lit(1).cast("long").alias("served"), none.alias("parents"))
    contexts = far_contexts.where("customers > once").select("*", none.alias("backs"))
    close = counted.where(F.col("kind") == NEAR_PAIR).select("part", "a", "v").mapInArrow(_first_seats, SEATS)
    apart = counted.where(F.col("kind") == FAR_PAIR).mapInArrow(_unpacked(near, parts, False), "h long, ctx long, c long").select(
        "h", "ctx", "c", F.lit(1).cast("long").alias("t"), F.lit(0.0).alias("share"))
    log, written = stirling(EXACT, d0), []
    for sweep in range(burn_in + samples + 1):
        # The parent's probabilities after the sweeps so far.
        sums = words.select("n", "served").unionByName(quiet.select("n", "served")).agg(
            *(F.coalesce(F.sum(x), F.lit(0)) for x in ("n", "served"))).first()
        whole, served = (of_far + int(of_word[x].sum()) + still for x, of_far in zip(("n", "served"), sums))
        back = (strength + d0 * served) / (strength + whole) / (facts["V"] + 1)

        def chances(n, served, whole=whole, back=back):
            return np.maximum(n - d0 * served, 0.0) / (strength + whole) + back

        kept = sweep > burn_in
        chance = F.greatest(F.col("n") - d0 * F.col("served"), F.lit(0.0)) / (strength + whole) + back
        words = words.withColumn("chance", chance)
        near_chance = chances(of_word["n"], of_word["served"])
        if kept:
            facts["unknown"].append(back)
            lone.append((1 - d0) / (strength + whole) + back)
            words = words.withColumn("parents", F.concat("parents", F.array("chance")))
            left = (strength + d1 * F.col("tables")) / (strength + F.col("customers"))
            contexts = contexts.withColumn("backs", F.concat("backs", F.array(left)))
            of_word["parents"].append(near_chance)
            of_context["backs"].append((strength + d1 * of_context["tables"]) / (strength + of_context["customers"]))
        if sweep == burn_in + samples:
            break
        shared = spark.sparkContext.broadcast((near_chance, of_context["tables"]))
        joined = apart.withColumns({"hk": _apart("h", facts), "ck": _apart("ctx", facts)}).join(
            words.select(F.col("h").alias("hk"), "chance"), "hk", "left").join(
            contexts.select(F.col("ctx").alias("ck"), "tables"), "ck", "left")
        at = [staging_path(spark, "step") for _ in range(4)]
        of_close, of_apart = _pair_seats(facts, sweep, sweep >= burn_in, shared)
        seats = durable(close.mapInArrow(of_close, SEATS).unionByName(
            joined.select("h", "ctx", "c", "t", "share", "chance", "tables").mapInArrow(of_apart, SEATS)), at[0])
        close, apart = seats.where("part is not null"), seats.where("part is null").select("h", "ctx", "c", "t", "share")
        tables = _summed_by_number(seats.select("part", "a", "ts", "h", "ctx", "t"), _near_tables(near, parts), 2, near)
        of_word["n"], of_context["tables"] = of_word["once"] + tables[0], of_context["once"] + tables[1]
        of_word["served"] = np.concatenate([
            draw_tables(n, np.maximum(served - of, 0), d0, strength, np.full(len(n), 1.0 / (facts["V"] + 1)), _keys((at,), sweep, codes.value), log)
            for n, of, at in zip(*(np.array_split(x, near // 10_000 + 1) for x in (of_word["n"], of_word["served"], np.arange(near))))]).astype(np.int64)
        added = apart.where(~_is_near("ctx", facts)).groupBy("ctx").agg(F.sum("t").alias("t"))
        contexts = durable(contexts.join(added, "ctx", "left").select(
            "ctx", "customers", "once", (F.col("once") + F.coalesce("t", F.lit(0))).alias("tables"), "backs"), at[1])
        added = apart.where(~_is_near("h", facts)).groupBy("h").agg(F.sum("t").alias("t"))
        words = durable(words.join(added, "h", "left").select(
            "h", "c", "once", (F.col("once") + F.coalesce("t", F.lit(0))).alias("n"), "served", "parents").mapInArrow(
            _word_seats(facts, sweep, served), "h long, c long, once long, n long, served long, parents array<double>"), at[2])
        quiet = durable(quiet.mapInArrow(_quiet_seats(facts, sweep, served, chances, kept), QUIET), at[3])
        shared.unpersist()
        for path in written:
            remove(spark, path)
        written = at
        del joined, added
        cleaned(spark)
    shares = counted.mapInArrow(_unpacked(near, parts, True), "h long, ctx long, c long").select(
        "h", "ctx", "c", F.lit(1 - d1).alias("share")).unionByName(_seated(seats, facts).select(
            "h", "ctx", "c", (F.col("share") / samples).alias("share")))
    near_words = _rows(spark, {"h": np.arange(near), "count": of_word["c"]}, "parents", of_word["parents"])
    near_contexts = _rows(spark, {"ctx": np.arange(near), "customers": of_context["customers"]}, "backs", of_context["backs"])
    left = (strength + d1 * F.col("tables")) / (strength + F.col("customers"))
    model = Tables(
        shares,
        durable(near_words.unionByName(words.select("h", F.col("c").alias("count"), "parents")).unionByName(
            quiet.mapInArrow(_quiet_rows(chances), near_words.schema)).unionByName(
            far_words.where("c = 1").select("h", F.col("c").alias("count"), F.array(*map(F.lit, lone)).alias("parents")))),
        durable(near_contexts.unionByName(contexts.select("ctx", "customers", "backs")).unionByName(
            far_contexts.where("customers = once").select("ctx", "customers", F.array_repeat(left, samples).alias("backs")))),
        counted, seats)
    for path in (*written[1:], *totals_at):
        remove(spark, path)
    return model, facts


def _seated(seats, facts):
    """The pairs met more often as rows; their shares are sums over the sweeps that were kept."""
    return seats.where("part is not null").mapInArrow(
        _seat_rows(facts["near"], facts["parts"]), "h long, ctx long, c long, share double").unionByName(
        seats.where("part is null").select("h", "ctx", "c", "share"))


def _rows(spark, columns, name, lists):
    """What numbered words have, as rows."""
    rows = np.column_stack([np.zeros((len(next(iter(columns.values()))), 0)), *lists])
    lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())
    schema = ", ".join([*(f"{x} long" for x in columns), f"{name} array<double>"])
    return spark.createDataFrame(pa.table({**columns, name: lists}), schema)


# ---- scoring ----------------------------------------------------------------

def _scorer(codes, shared, parts, most=1_000_000):
    """A row per text with the sums over the tokens that the task can score, and rows with the other tokens for the parts."""
    def asked(held, block, near):
        word, last, d = (np.concatenate(x) for x in zip(*held))
        d = (d - block).astype(np.uint32)
        w, c = ((x >= 0) & (x < near) for x in (word, last))
        if (w & c).any():
            rest, part = np.divmod((last * near + word)[w & c], parts)
            yield _packed(ASK_NEAR, part, block, a=rest.astype(np.uint32), d=d[w & c])
        for kind, chosen in ((ASK_FAR, w ^ c), (ASK_BOTH, ~w & ~c)):
            if chosen.any():
                h, ctx = word[chosen], last[chosen]
                part = _part_of(ctx, parts) if kind == ASK_BOTH else _home(h, ctx, near, parts)
                yield _packed(kind, part, block, a=h, b=ctx, d=d[chosen])

    def run(batches):
        pairs, own, base, parents, _, backs = shared.value
        near, coded_by, held, size, block = len(base), _coder(codes.value), [], 0, None
        for part in _groups(batches):
            key = part.column(0).field("key").to_numpy()
            block = key[0] if block is None else block
            hashes, numbers, before, text = _tokens(part.column(1))
            coded, n = coded_by(hashes), part.num_rows
            word, last = coded[numbers], coded[before]
            known = (word >= 0) & (word < near)
            close = np.flatnonzero(known & (last >= 0) & (last < near))
            code = last[close] * near + word[close]
            # In the order of their codes, what is looked up lies close together.
            order = np.argsort(code)
            close, code = close[order], code[order]
            w, c = word[close], last[close]
            asked_for = np.ones(len(word), bool)
            scored, s = close[:0], np.zeros(0)
            chance = _mean(parents, w, backs, c)
            if len(pairs):
                place = _places(pairs, code)
                met = place >= 0
                scored = close[met]
                asked_for[scored] = False
                chance[met] += own[place[met]]
            if len(close):
                s = np.log10(chance)
            if asked_for.any():
                held.append((word[asked_for], last[asked_for], key[text[asked_for]]))
                size += len(held[-1][0])
            counts = [np.bincount(text, minlength=n), np.bincount(text[known], minlength=n)]
            sums = [np.bincount(text[x], y, n).astype(np.float64) for x, y in ((known, base[word[known]]), (close, s))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, (*counts, *sums)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                 *(pa.nulls(n, pa.binary()) for _ in "abd")], names=[*out, *DEALT])
            if size > most:
                yield from filled(part.schema.field(0).type, asked(held, block, near))
                held, size, block = [], 0, None
        if held:
            yield from filled(part.schema.field(0).type, asked(held, block, near))

    def filled(row, dealt):
        for x in dealt:
            n = x.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, row), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()),
                 *(x.column(name) for name in DEALT)], names=[*out, *DEALT])

    out = ["row", "n_tokens", "n_known", "base", "score"]
    return run


DEALT = ["part", "kind", "block", "a", "b", "d"]


def _mean(parents, w, backs, c):
    """The parent's part of the probability, averaged over the sweeps."""
    return sum(parents[:, i][w] * backs[:, i][c] for i in range(parents.shape[1])) / parents.shape[1]


def _places(keys, asked):
    """Where each asked key is in the sorted `keys`; -1 if it is not there."""
    if not len(keys):
        return np.full(len(asked), -1)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[place] == asked, place, -1)


def _looked_up(keys, values, asked, missing):
    """The values of the asked keys; `missing` for those that are not there."""
    order = np.argsort(keys)
    place = _places(keys[order], asked)
    found = values[order[place]] if len(keys) else np.zeros((len(asked), *values.shape[1:]), values.dtype)
    absent = place < 0
    found[absent] = missing
    return found


def _pair_shares(near, parts, share, samples):
    """Pairs met once, packed with their share; that of two numbered words is a sum over the sweeps."""
    def run(batches):
        for row in _rows_of(batches):
            once = np.frombuffer(row["v"], np.int64) == 1
            if once.any():
                a = np.frombuffer(row["a"], np.uint32 if row["kind"] == NEAR_PAIR else np.int64)[once]
                b = {"b": np.frombuffer(row["b"], np.int64)[once]} if row["kind"] == FAR_PAIR else {}
                yield _packed(row["kind"], np.full(len(a), row["part"]), a=a, v=np.full(len(a), share * (samples if row["kind"] == NEAR_PAIR else 1)), **b)

    return run


def _pack(kind, near, parts):
    """Rows of seated pairs, words or contexts, packed for the parts."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [x.to_numpy(zero_copy_only=False) for x in batch.columns[:2]]
            v = batch.column(2)
            v = v.flatten().to_numpy().reshape(batch.num_rows, -1) if pa.types.is_list(v.type) else v.to_numpy()
            if kind == FAR_PAIR:
                yield from _packed_pairs(*columns, v, near, parts)
            else:
                yield _packed(kind, _part_of(columns[0], parts), a=columns[0], b=columns[1], v=v)

    return run


def _with_contexts(samples, near, parts):
    """Tokens of two words without a number get what their context has, and go on to the part of the word."""
    def run(key, rows):
        out = []
        has, asks = _of_kind(rows, CONTEXT), _of_kind(rows, ASK_BOTH)
        facts = np.column_stack([_values(has, "b", np.int64), _values(has, "v", np.float64).reshape(-1, samples)])
        for ask in asks.to_batches():
            for at in range(ask.num_rows):
                one = ask.slice(at, 1)
                h, ctx, d = (_values(one, x, kind) for x, kind in (("a", np.int64), ("b", np.int64), ("d", np.uint32)))
                v = _looked_up(_values(has, "a", np.int64), facts, ctx, [0.0] + [1.0] * samples)
                out.append(_packed(ASK_MET, _part_of(h, parts), one["block"][0].as_py(), a=h, b=ctx, d=d, v=v))
        return pa.Table.from_batches(out) if out else rows.slice(0, 0)

    return run


SUMS = "block long, d binary, s binary, b binary, k binary"


def _answers(facts, shared):
    """What the tokens that a part was asked for add to the sums of their texts."""
    near, parts, samples, strength = (facts[x] for x in ("near", "parts", "samples", "strength"))
    whole, unknown = facts["N"] + 0.5 * (facts["V"] + 1), facts["unknown"]

    def run(key, rows):
        _, _, _, parents, customers, backs = shared.value
        out = []

        def summed(asks, s, b=None, k=None):
            """Sums per text of a block; a block's tokens are in the order of its texts."""
            d = _values(asks, "d", np.uint32)
            sizes = [len(x) // 4 for x in asks["d"].to_pylist()]
            row = np.repeat(np.arange(len(sizes)), sizes)
            new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(d.astype(np.int64), prepend=-1) != 0))
            ends = np.append(np.searchsorted(row[new], np.arange(len(sizes))), len(new))
            sums = [np.add.reduceat(x, new) if x is not None else np.zeros(len(new)) for x in (s, b, k)]
            for at, block in enumerate(asks["block"].to_pylist()):
                of = slice(ends[at], ends[at + 1])
                out.append((block, d[new[of]].tobytes(), *(x[of].tobytes() for x in sums)))

        asks, has = _of_kind(rows, ASK_NEAR), _of_kind(rows, NEAR_PAIR)
        if asks.num_rows and has.num_rows:
            asked, own = _values(asks, "a", np.uint32), np.zeros(0)
            share = _looked_up(_values(has, "a", np.uint32), _values(has, "v", np.float64), asked, 0.0) / samples
            met = np.flatnonzero(share)
            c, w = np.divmod(asked[met].astype(np.int64) * parts + key[0].as_py(), near)
            own, s = share[met] / (strength + customers[c]), np.zeros(len(asked))
            s[met] = np.log1p(own / _mean(parents, w, backs, c)) / np.log(10)
            summed(asks, s)
        has = _of_kind(rows, FAR_PAIR)
        pairs = _pair_hash(_values(has, "a", np.int64), _values(has, "b", np.int64)), _values(has, "v", np.float64)
        words, contexts = (
            (_values(x, "a", np.int64), np.column_stack([_values(x, "b", np.int64), _values(x, "v", np.float64).reshape(-1, samples)]))
            for x in (_of_kind(rows, WORD), _of_kind(rows, CONTEXT)))
        for kind in (ASK_FAR, ASK_MET):
            asks = _of_kind(rows, kind)
            if not asks.num_rows:
                continue
            h, ctx = _values(asks, "a", np.int64), _values(asks, "b", np.int64)
            share = _looked_up(*pairs, _pair_hash(h, ctx), 0.0)
            p = _looked_up(*words, h, [0.0, *unknown])
            _put(p, np.column_stack([np.zeros(near), parents]), h)
            if kind == ASK_MET:
                q = _values(asks, "v", np.float64).reshape(-1, samples + 1)
            else:
                q = _looked_up(*contexts, ctx, [0.0] + [1.0] * samples)
                _put(q, np.column_stack([customers, backs]), ctx)
            s = np.log10(share / (strength + q[:, 0]) + (p[:, 1:] * q[:, 1:]).mean(axis=1))
            far = ~((h >= 0) & (h < near))
            summed(asks, s, np.where(far, np.log10((p[:, 0] + 0.5) / whole), 0.0), (far & (p[:, 0] > 0)).astype(np.float64))
        return pa.table(dict(zip(("block", "d", "s", "b", "k"), map(list, zip(*out)))) if out else {x: [] for x in ("block", "d", "s", "b", "k")},
                        schema=pa.schema([("block", pa.int64()), *((x, pa.binary()) for x in "dsbk")]))

    return run


def _of_texts(key, rows):
    """The sums of a block's texts over all parts."""
    d = _values(rows, "d", np.uint32)
    met = np.unique(d)
    sums = [np.bincount(d, _values(rows, x, np.float64))[met] for x in "sbk"]
    return pa.table([pa.array(key[0].as_py() + met.astype(np.int64)), *map(pa.array, sums)], names=["key", "s", "b", "k"])


def score(docs: DataFrame, model, facts, id="doc_id", text="text", frequent=FREQUENT_PAIRS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row per row of `docs`."""
    spark, whole = docs.sparkSession, facts["N"] + 0.5 * (facts["V"] + 1)
    near, parts, samples, strength = (facts[x] for x in ("near", "parts", "samples", "strength"))
    seats = _seated(model.seats, facts).select("h", "ctx", "c", (F.col("share") / samples).alias("share"))
    both = _is_near("h", facts) & _is_near("ctx", facts)
    lowest = _lowest(seats.where(both), "c", frequent)
    top = seats.where(both & _at_least("c", lowest)).select((F.col("ctx") * near + F.col("h")).alias("code"), "ctx", "share").toArrow()
    count, parents = _by_number(model.words, "h", facts, ["count", "parents"])
    customers, backs = _by_number(model.contexts, "ctx", facts, ["customers", "backs"])
    parents, backs = (np.asfortranarray(x.reshape(near, samples)) for x in (parents, backs))
    order = np.argsort(top["code"].to_numpy())
    own = top["share"].to_numpy() / (strength + customers[top["ctx"].to_numpy()])
    shared = spark.sparkContext.broadcast((
        top["code"].to_numpy()[order], own[order], np.log10((count + 0.5) / whole), parents, customers, backs))
    scored = durable(docs.select(
        F.struct(F.col(f"`{id}`").alias("id"), F.monotonically_increasing_id().alias("key")).alias("row"), F.col(f"`{text}`")).mapInArrow(
        _scorer(facts["codes"], shared, parts),
        f"row struct<id:{docs.schema[id].dataType.simpleString()},key:bigint>, n_tokens long, n_known long, base double, "
        "score double, part int, kind int, block long, a binary, b binary, d binary"), compression="zstd")
    asked = scored.where("part is not null").select(*DEALT, F.lit(None).cast("binary").alias("v"))
    words = model.words.where(~_is_near("h", facts))
    contexts = model.contexts.where(~_is_near("ctx", facts))
    held = model.seats.where("part is null").select("h", "ctx", F.col("share") / samples).mapInArrow(_pack(FAR_PAIR, near, parts), PACKED)
    for kind, frame in ((WORD, words), (CONTEXT, contexts)):
        held = held.unionByName(frame.mapInArrow(_pack(kind, near, parts), PACKED))
    held = durable(held, compression="zstd")
    forward = held.where(F.col("kind") == CONTEXT).unionByName(asked.where(F.col("kind") == ASK_BOTH))
    forward = durable(forward.groupBy("part").applyInArrow(_with_contexts(samples, near, parts), PACKED), compression="zstd")
    asked = asked.where(F.col("kind") != ASK_BOTH).unionByName(forward)
    cleaned(spark)
    sums = []
    # A round takes its share of the parts, and its shuffle files go before the next one begins.
    for turn in range(ROUNDS):
        mine = F.col("part") % ROUNDS == turn
        has = model.counted.where(mine).mapInArrow(_pair_shares(near, parts, 1 - facts["d1"], samples), PACKED)
        has = has.unionByName(model.seats.where("part is not null").where(mine).select(
            "part", F.lit(NEAR_PAIR).alias("kind"), F.lit(None).cast("long").alias("block"), "a", *(F.lit(None).cast("binary").alias(x) for x in "bd"),
            F.col("shares").alias("v")))
        answers = has.unionByName(held.where(mine)).unionByName(asked.where(mine)).groupBy("part").applyInArrow(_answers(facts, shared), SUMS)
        sums.append(durable(answers.groupBy("block").applyInArrow(_of_texts, "key long, s double, b double, k double")))
        del has, answers
        cleaned(spark)
    sums = reduce(DataFrame.unionByName, sums).groupBy("key").agg(F.sum("s").alias("s"), F.sum("b").alias("b"), F.sum("k").alias("k"))
    none = F.lit(0.0)
    return scored.where("part is null").select("row.id", "row.key", "n_tokens", "n_known", "base", "score").join(
        sums.toDF("key", "s", "b", "k"), "key", "left").select(
        F.col("id").alias(id), "n_tokens", (F.col("n_known") + F.coalesce(F.col("k"), none).cast("long")).alias("n_known"),
        F.lit(facts["N"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", none)).alias("base_score"), (F.col("score") + F.coalesce("s", none)).alias("score"))


def held_out(id, fold=5, part=1):
    """True for the documents that are kept from training."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % fold == part
