import random

from helpers import docs

from qa_analytics.llm import mixing


def rows(n=900):
    rng = random.Random(4)
    out = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["b", "a", "a", "a", "é", "c", None])) for i in range(n)]
    return out + [(n, None, "a"), (n + 1, "", "b")]


def plain_targets(table):
    sizes = {}
    for _, text, source in table:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return sizes, {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def test_targets_balance_and_reruns(spark):
    table = rows()
    frame = docs(spark, table, size="x", n="y")
    got = [r.asDict() for r in mixing.taken(frame).collect()]
    source = {r[0]: r[2] for r in table}
    sizes, target = plain_targets(table)
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in table)
    words = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
        words[s] = words.get(s, 0) + r["taken"]
    assert all(abs(words[s] - target[s]) <= 60 for s in target)
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mixing.taken(frame.repartition(3)).collect())


def test_flight_keeps_both_totals():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randrange(0, 50) for _ in range(200)]
        chances = [rng.random() for _ in sizes]
        words, count = sum(s * c for s, c in zip(sizes, chances)), sum(chances)
        moved = list(chances)
        mixing.flight(sizes, moved, rng)
        assert abs(sum(s * c for s, c in zip(sizes, moved)) - words) < 1e-6
        assert abs(sum(moved) - count) < 1e-6
        assert sum(0 < c < 1 for c in moved) <= 2
        mixing.flight(sizes, moved, rng, land=True)
        assert set(moved) <= {0, 1} and abs(sum(s * c for s, c in zip(sizes, moved)) - words) <= 100


def test_inclusion_is_unbiased():
    hits = [0] * 12
    for seed in range(4000):
        chances = [0.3] * 12
        mixing.flight(list(range(1, 13)), chances, random.Random(seed), land=True)
        hits = [h + c for h, c in zip(hits, chances)]
    assert all(abs(h / 4000 - 0.3) < 0.04 for h in hits)


def test_blocks_are_joined_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    table = rows(600)
    sizes, target = plain_targets(table)
    source, words = {r[0]: r[2] for r in table}, {}
    for r in mixing.taken(docs(spark, table)).collect():
        words[source[r.doc_id]] = words.get(source[r.doc_id], 0) + r.taken
    assert all(abs(words[s] - target[s]) <= 60 for s in target)


def test_mix_repeats_rows_and_keeps_columns(spark):
    table = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "d e", "y"), (3, None, "y"), (None, "f g h i", None)]
    frame = docs(spark, table, mix_n="own")
    out = mixing.mix(frame)
    assert out.columns == frame.columns
    got = sorted((str(r.doc_id), r.text, r.mix_n) for r in out.collect())
    sizes, target = plain_targets(table)
    assert all(r[1] and r[2] == "own" for r in got)
    copies = sum(1 for r in got if r[0] == "1")
    assert abs(3 * copies - target["x"]) <= 3
    assert mixing.taken(frame.limit(0)).count() == 0 and mixing.mix(frame.limit(0)).count() == 0
