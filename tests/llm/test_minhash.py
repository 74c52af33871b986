import random

import numpy as np
import pyarrow as pa
from helpers import by_id, docs

from qa_analytics.llm import minhash
from qa_analytics.llm.components import connected_components


def sets(rows, k):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    return out


def components(found, percent):
    ids = sorted(found)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and found[a] and found[b]:
                both = len(found[a] & found[b])
                if 100 * both >= percent * (len(found[a]) + len(found[b]) - both) and top(a) != top(b):
                    root[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


def noisy_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, n = [(0, None), (1, ""), (2, "Solo"), (3, "solo"), (4, "two words"), (5, "  \n ")], 6
    for size in (8, 40, 120, 300):
        for _ in range(3):
            base = [rng.choice(words) for _ in range(size)]
            for _ in range(9):
                text = list(base)
                for _ in range(rng.randrange(0, max(2, size // 25))):
                    text[rng.randrange(size)] = rng.choice(words)
                rows.append((n, " ".join(w.upper() if rng.random() < 0.1 else w for w in text)))
                n += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = noisy_rows()
    for k, percent in ((3, 85), (5, 80)):
        got = by_id(minhash.near_duplicates(docs(spark, rows), words=k, percent=percent))
        found = sets(rows, k)
        truth = components(found, percent)
        assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in found.items()}
        assert {i: r.component_id for i, r in got.items()} == truth
        assert all(r.kept == (i == truth[i]) for i, r in got.items())


def test_star_buckets_find_links_that_miss_the_centre(spark):
    """A chain: neighbours are alike, the ends are not; all end in one component."""
    words = [f"c{i}" for i in range(260)]
    rows = [(i, " ".join(words[6 * i:6 * i + 200])) for i in range(10)]
    got = by_id(minhash.near_duplicates(docs(spark, rows), words=3, percent=85, bands=84, rows=3))
    assert {r.component_id for r in got.values()} == {0}


def test_a_hot_centre_is_dealt_to_slots(spark, monkeypatch):
    """One text with 120 near copies and another that comes before it; its pairs spread, the result stays."""
    monkeypatch.setattr(minhash, "SHARE", 8)
    base = [f"h{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1:])) for i, k in ((i, 20 + i) for i in range(120))]
    rows += [(500, " ".join(base)), (501, " ".join(f"o{i}" for i in range(200))), (-1, " ".join(base[:199]))]
    got = by_id(minhash.near_duplicates(docs(spark, rows), words=3, percent=85))
    assert {i: r.component_id for i, r in got.items()} == components(sets(rows, 3), 85)
    whole = minhash.hash_sets(docs(spark, rows).withColumnRenamed("doc_id", "id"), 3)
    pairs = spark.createDataFrame([(i, 500, 121) for i in range(120)] + [(500, 501, 121)], "a long, b long, n long")
    found = sets(rows, 3)
    assert {(r.a, r.b): (r.both, r.either) for r in minhash.compared(pairs, whole).collect()} == {
        (a, b): (len(found[a] & found[b]), len(found[a] | found[b])) for a, b in [*((i, 500) for i in range(120)), (500, 501)]}
    slots = pairs.selectExpr("b", "pmod(xxhash64(a), ceil(n / 8)) slot").groupBy("b", "slot").count()
    assert slots.agg({"count": "max"}).first()[0] < 30


def test_repeated_rows_nulls_and_clashing_columns(spark):
    rows = [(7, "a b c d e f g"), (7, "a b c d e f g"), (8, "A b c d e f g"), (None, "a b c d e f g")]
    frame = docs(spark, rows, id="x", component_id="y", key="z")
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(frame).collect())
    assert got == [("7", 7, True), ("7", 7, True), ("8", 7, False), ("None", None, True)]
    kept = minhash.without_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["7", "None"]
    assert minhash.near_duplicates(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_densified_bins_agree_with_set_similarity():
    rng = np.random.RandomState(1)
    bounds, orders = minhash.bin_bounds(252), minhash.bin_orders(252)
    for n in (12, 60, 900):
        alike = []
        for _ in range(40):
            both = rng.randint(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            a, b = (np.unique(np.append(both, rng.randint(0, 1 << 63, n // 6, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)))
                    for _ in range(2))
            alike.append((minhash.densified(a, bounds, orders) == minhash.densified(b, bounds, orders)).mean())
        assert abs(np.mean(alike) - n / (n + 2 * (n // 6))) < 0.05


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(25)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    known = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            known.setdefault(a, {a}), known.setdefault(b, {b})
            both = known[a] | known[b]
            for x in both:
                known[x] = both
    assert got == {x: min(s) for x, s in known.items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unlike_texts_of_one_id_stay_and_copies_without_an_id_go(spark):
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w x"), (1, "q r s t u v w x"), (2, "Q r s t u v w x"), (None, "m n o p q"),
            (None, "m n o p q"), (None, "other words than those"), (None, None), (None, None), (3, "h i j k l m"), (3, None)]
    frame = docs(spark, rows, row_key="z")
    kept = minhash.without_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in [
        (1, "a b c d e f g"), (1, "q r s t u v w x"), (None, "m n o p q"), (None, "other words than those"), (None, None),
        (3, "h i j k l m"), (3, None)])


def test_common_sizes_of_sorted_sets_without_hash_tables():
    rng = np.random.RandomState(3)
    sets = [np.unique(rng.randint(0, 60, n).astype(np.uint64) * np.uint64(0x0600000000000001)) for n in (0, 1, 5, 40, 200)]
    pairs = [(x, y) for x in sets for y in sets]
    lists = [pa.array([list(p[k].view(np.int64)) for p in pairs], pa.list_(pa.int64())) for k in (0, 1)]
    ids = pa.array(range(len(pairs)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, *lists], names=["a", "b", "set_a", "set_b"])
    for part in (batch, batch.slice(7, 11)):
        out, = minhash.common_sizes([part])
        at = part.column(0).to_pylist()
        assert out.column(2).to_pylist() == [len(np.intersect1d(*pairs[i])) for i in at]
        assert out.column(3).to_pylist() == [len(pairs[i][0]) + len(pairs[i][1]) for i in at]


def changed(base, rng, n):
    """A text with `n` words of `base` replaced."""
    words = list(base)
    for i in rng.sample(range(len(base)), n):
        words[i] = f"y{rng.randrange(10 ** 6)}"
    return words


def test_members_outside_the_largest_component_are_not_compared_in_pairs_of_full_sets(spark, monkeypatch):
    """Copies of one text, most too different from it and from each other; some have a copy of their own."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(700)]
    texts = [base] + [changed(base, rng, rng.randrange(1, 10)) for _ in range(8)] + [
        changed(base, rng, rng.randrange(22, 32)) for _ in range(140)]
    texts += [changed(t, rng, 5) for t in texts[40:46]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    seen, compared = [], minhash.compared

    def counted(pairs, sets):
        seen.append(pairs.count())
        return compared(pairs, sets)

    monkeypatch.setattr(minhash, "compared", counted)
    monkeypatch.setattr(minhash, "BLOCK", 9000, raising=False)  # several blocks of about 13 texts
    got = by_id(minhash.near_duplicates(docs(spark, rows), words=3, percent=85))
    truth = components(sets(rows, 3), 85)
    assert {i: r.component_id for i, r in got.items()} == truth
    assert len(set(truth.values())) > 40
    assert 0 < sum(seen) < 8 * len(rows), seen


def test_links_of_outside_rows_equal_brute_force():
    rng = np.random.RandomState(11)
    for trial in range(60):
        n, base = rng.randint(1, 30), rng.randint(0, 400, rng.randint(1, 150))
        found = [np.unique(np.append(base[rng.rand(len(base)) > rng.rand() * 0.3], rng.randint(0, 2000, rng.randint(0, 15)))) for _ in range(n)]
        found = [s if rng.rand() > 0.05 else s[:0] for s in found]
        label = rng.randint(0, max(1, n // 2), n) if trial % 2 else np.arange(n)
        outside, met = rng.rand(n) < 0.5, rng.rand(n) < 0.7
        sizes = np.array([len(s) for s in found])
        links = list(zip(*(x.tolist() for x in minhash.outside_links(np.concatenate(found), sizes, label, outside, met, 80))))
        both = {(a, b): len(np.intersect1d(found[a], found[b])) for a in np.flatnonzero(outside) for b in np.flatnonzero(met) if a != b}
        truth = {p for p, x in both.items() if x and 100 * x >= 80 * (sizes[p[0]] + sizes[p[1]] - x)}
        assert truth.issuperset(links)

        def joined(pairs):
            at = label.copy()
            for _ in range(n):
                for a, b in pairs:
                    at[a] = at[b] = min(at[a], at[b])
                    at = np.array([at[label == v].min() for v in label])
            return at.tolist()

        assert joined(links) == joined(truth)


def test_words_hash_alike_at_any_place():
    rng = random.Random(3)
    for _ in range(300):
        text = bytes(rng.choice(b"abcdABC\x00\x0b \t\n  \xc3\xa9\xff\x85\x1c") for _ in range(rng.randrange(60)))
        text = text.replace(b"c", b"c" * rng.choice([1, 7, 8, 9, 16, 127, 130]))
        words = text.lower().split()
        starts, hashes = minhash.word_hashes(text)
        assert [text.lower()[i:i + len(w)] for i, w in zip(starts, words)] == words
        assert hashes.tolist() == [minhash.word_hashes(b"\n" + w + b" x")[1][0] for w in words]
        assert len(set(hashes.tolist())) == len(set(words))
    texts = [None, b"", b" \n", b"a", b"a b", b"a b c d a B c d", b"x" * 700_000 + b" y z", b"p q r s"]
    assert [len(s) for s in minhash.shingle_sets(texts, 3)] == [0, 0, 0, 1, 1, 4, 1, 2]
    assert [s.tolist() for s in minhash.shingle_sets(texts, 3)] == [next(minhash.shingle_sets([t], 3)).tolist() for t in texts]
