import itertools
import random

from helpers import docs

from qa_analytics.llm import packing


def padded(counts, tops, ends):
    total, start = 0, 0
    for e in ends:
        total += tops[e] * sum(counts[start:e + 1])
        start = e + 1
    return total


def test_boundaries_are_optimal():
    rng = random.Random(6)
    for _ in range(60):
        m, k = rng.randrange(1, 9), rng.randrange(1, 6)
        counts, tops = [rng.randrange(1, 20) for _ in range(m)], sorted(rng.sample(range(1, 100), m))
        best = min(padded(counts, tops, [*c, m - 1]) for n in range(min(k, m)) for c in itertools.combinations(range(m - 1), n))
        assert padded(counts, tops, packing.boundaries(counts, tops, k)) == best
    assert packing.boundaries([], [], 3) == []


def test_batches_stay_within_the_budget(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.1)))) for i in range(700)]
    rows += [(1000, None), (1001, ""), (1002, "w " * 900), (5, rows[5][1]), (5, rows[5][1])]
    got = packing.pack(docs(spark, rows, bucket="x", h="y"), buckets=5, budget=256).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((i, len((t or "").split())) for i, t in rows)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, _), own in batches.items():
        assert sorted(r.position for r in own) == list(range(len(own)))
        assert len(own) == 1 or len(own) * own[0].bucket_length <= 256
    full = {}
    for (bucket, _), own in batches.items():
        full.setdefault(bucket, []).append(len(own))
    assert all(sum(n < max(sizes) for n in sizes) <= 1 for sizes in full.values())


def test_bins_grow_with_length_and_empty_tables(spark):
    lengths = [*range(0, 3000, 7), 10**6, 2**31]
    bins = [r[0] for r in spark.createDataFrame([(x,) for x in lengths], "n long").select(
        packing.length_bin(packing.F.col("n"))).collect()]
    assert bins == sorted(bins) and all(n <= b <= n * 1.04 + 1 for n, b in zip(lengths, bins))
    assert packing.pack(docs(spark, [(1, "x")]).limit(0)).count() == 0
    assert packing.pack(docs(spark, [(1, None)])).first().batch == 0
