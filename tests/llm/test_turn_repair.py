"""Conversation repair against a plain table of strings, with small blocks and colliding hashes."""

import hashlib
import random

import pytest
from helpers import by_id
from pyspark.sql import types as T

from qa_analytics.llm import turn_repair as R

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType())])


def plain(codes):
    """(cost, edits) with whole strings and no shared prefixes."""
    table = {0: (0, "")}
    for code in codes:
        cls, fault = R.DECODED[code]
        for _ in range(3):
            for q, (cost, edits) in list(table.items()):
                table[R.DUE[q]] = min(table.get(R.DUE[q], (10**9, "")), (cost + 5, edits + "I"))
        after = {}
        for q, (cost, edits) in table.items():
            ways = [(q, cost + 2, "D")]
            if fault in "kt":
                more = 5 if fault == "t" else 0
                ways.append((R.DUE[q], cost + 1 + more, "R"))
                if (q, cls) in R.KEPT:
                    ways.append((R.KEPT[q, cls], cost + more, "K"))
            for to, c, e in ways:
                after[to] = min(after.get(to, (10**9, "")), (c, edits + e))
        table = after
    return min((cost + 5 * len(R.ENDING[q]), edits + R.ENDING[q]) for q, (cost, edits) in table.items())


def dealt(n, seed, letters=None):
    rng = random.Random(seed)
    return "".join(rng.choice(letters or sorted(R.DECODED)) for _ in range(n))


def whole(codes, audits=None):
    ends = R.solve(codes, 0, audits)
    return min((c + 5 * len(R.ENDING[q]), e + R.ENDING[q]) for q, (c, e) in ends.items())


# Rows whose repairs tie a lot: roles in the wrong places.
TIED = [R.letter(c, "k") for c in "sua-"] + [R.letter("u", "t"), R.letter("a", "d")]


@pytest.mark.parametrize("seed", range(40))
def test_solution_equals_plain_table(seed):
    for letters in (None, TIED):
        codes = dealt(1 + seed * 3, seed, letters)
        assert whole(codes) == plain(codes)


@pytest.mark.parametrize("modulus", [1, 2, 7])
def test_collisions_of_hashes_change_nothing(modulus):
    for seed in range(20):
        codes = dealt(40, seed, TIED)
        assert whole(codes, R.Audits(modulus, 3)) == plain(codes)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_give_the_same_path(size):
    for seed in range(30):
        codes = dealt(1 + seed, seed, TIED if seed % 2 else None)
        parts = [codes[i:i + size] for i in range(0, len(codes), size)]
        solved = [{(s, e): x for s in R.STATES for e, x in R.solve(p, s).items()} for p in parts]
        matrices = []
        for ways in solved:
            order = sorted({a for _, a in ways.values()})
            matrices.append({k: (c, order.index(a)) for k, (c, a) in ways.items()})
        cost, path, ending = R.best_path(matrices, R.Audits(3, 2))
        edits = "".join(w[path[i], path[i + 1]][1] for i, w in enumerate(solved)) + ending
        assert (cost, edits) == plain(codes)


def test_strings_compare_like_python():
    audits, strings = R.Audits(5, 2), {0: ""}
    rng = random.Random(1)
    for _ in range(400):
        node = rng.choice(list(strings))
        symbol = rng.choice("DKR")
        strings[audits.add(node, ord(symbol))] = strings[node] + symbol
    for _ in range(3000):
        a, b = rng.choice(list(strings)), rng.choice(list(strings))
        assert audits.less(a, b) == (strings[a] < strings[b])


def expected(rows):
    """A conversation's result from its rows (turn, role, text) after damage, in order."""
    seen, codes, faults = set(), [], []
    for _, role, text in rows:
        stripped = text.strip(" \t\n\v\f\r")
        fault = "b" if not stripped else "d" if (role, text) in seen else "t" if stripped[-1] not in ".!?" else "k"
        seen.add((role, text))
        faults.append(fault)
        codes.append(R.letter(role[:1] if role[:1] in ("s", "u", "a") else "-", fault))
    cost, audit = plain(codes)
    lines, state, place = [], 0, 0
    for e in audit:
        if e == "I":
            state = R.DUE[state]
            lines.append(R.ROLE[state] + ":")
            continue
        _, role, text = rows[place]
        if e == "K":
            state = R.KEPT[state, role[:1]]
            lines.append(role + ":" + text)
        elif e == "R":
            state = R.DUE[state]
            lines.append(R.ROLE[state] + ":" + text)
        place += 1
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": faults.count("b"),
        "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:])), "cost": cost,
        "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


@pytest.mark.parametrize("block", [2, 4096])
def test_tables_with_nulls_ties_repeats_and_a_hot_conversation(spark, block):
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", ""], ["", " \n", "Hi.", "What?", "cut off", "Done!", "é.  "]
    rows = [(9, t, rng.choice(roles), rng.choice(texts) + str(t % 7) * (t % 3)) for t in range(300)]
    rows += [(c, t if rng.random() > 0.2 else None, rng.choice(roles), rng.choice(texts)) for c in range(8) for t in range(c)]
    rows += [(None, None, "user", "Hello."), (None, None, "assistant", "Hello."), (20, 5, None, None), (20, 5, "user", "x." * 5000)]
    rows += [(21, 1, "user", "Same.")] * 5
    frame = spark.createDataFrame([(*r, "extra", "pos") for r in rows], T.StructType([
        *ROWS.fields, T.StructField("pos", T.StringType()), T.StructField("audit", T.StringType())]))
    ids = spark.createDataFrame([(77,), (9,)], "conv_id long")
    got = by_id(R.repair(frame, ids, block), "conv_id")
    by_conversation = {}
    for c, t, role, text in rows:
        by_conversation.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert set(got) == {*by_conversation, 77}
    for c, members in by_conversation.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        assert {k: v for k, v in got[c].asDict().items() if k != "conv_id"} == expected(members), c
    assert got[77].asDict() == {
        "conv_id": 77, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
        "repaired_sha256": hashlib.sha256(b"").hexdigest()}


def test_no_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert R.repair(R.damage(empty), empty).collect() == []


def test_damage_follows_the_hash(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in (None, 1, 2)]
    got = {}
    for r in R.damage(spark.createDataFrame(rows, ROWS)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        deed = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, "One Two")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(deed, [(role, text)])
        assert got.get((c, t), []) == want
