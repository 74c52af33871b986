import tracemalloc

import numpy as np
import pandas as pd
import pytest

from qa_analytics.llm import graph_dedup


def vectors(n=500, d=24, copies=120, seed=3):
    rng = np.random.RandomState(seed)
    x = rng.randn(n, d)
    near = x[rng.randint(0, n, copies)] + 0.03 * rng.randn(copies, d)
    hot = x[:1] + 0.04 * rng.randn(150, d)
    return np.vstack([x, near, hot])


def truth(x, ids, low=0.95):
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = y @ y.T >= low
    np.fill_diagonal(close, False)
    root = list(range(len(x)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(close)):
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {ids[i]: (int(close[i].sum()), ids[top(i)]) for i in range(len(x))}


@pytest.mark.parametrize("cell,part", [(1024, 4096), (100, 64)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, cell, part):
    monkeypatch.setattr(graph_dedup, "CELL", cell)
    monkeypatch.setattr(graph_dedup, "PART", part)
    x = vectors()
    ids = list(range(100, 100 + len(x)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in graph_dedup.near_duplicates(table).collect()}
    want = truth(x, ids)
    found, true = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert found >= 0.98 * true
    assert sum(got[i][1] == want[i][1] for i in ids) >= 0.98 * len(ids)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (3, [2.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (10, [0.0, 1.0, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [0.0, 5.0, 0.0]), (None, [1.0, 0.0]),
            (13, [1e308, 0.0]), (14, [-0.0, 1e-300])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, n_links string")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in graph_dedup.near_duplicates(table).collect())
    near = {"1": (4, 1, True), "2": (4, 1, False), "13": (4, 1, False), "10": (1, 10, True), "12": (1, 10, False)}
    for i, links, component, kept in got:
        if i in near:
            assert (links, component, kept) == near[i]
        elif i == "3":
            assert (links, component, kept) == (4, 1, False)
        elif i == "None":
            assert (links, component, kept) == (0, None, True)
        else:
            assert (links, component, kept) == (0, int(i), True)
    assert len(got) == len(rows)
    assert graph_dedup.near_duplicates(table.limit(0)).count() == 0


def test_graph_is_sparse_and_reachable():
    x = graph_dedup.unit(vectors(300))
    lists = graph_dedup.pruned_graph(x)
    seen, front = set(), [graph_dedup.medoid(x)]
    while front:
        seen |= set(front)
        front = [v for u in front for v in lists[u].tolist() if v not in seen]
        front = list(set(front))
    assert len(seen) == len(x)
    assert np.mean([len(own) for own in lists]) < 2 * graph_dedup.DEGREE


def test_memberships_hold_no_more_than_one_number_per_pair_of_cells():
    rng = np.random.RandomState(5)
    x, c = graph_dedup.unit(rng.randn(200, 64)), graph_dedup.unit(rng.randn(600, 64))
    tracemalloc.start()
    near = graph_dedup.memberships(x, c, 0.05)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * 8 * 600 * 600
    s = x @ c.T
    apart = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2)
    home = s.argmax(1)
    want = s.max(1)[:, None] - s <= 0.05 * apart[home]
    want[np.arange(200), home] = True
    assert (near == want).all()


def hot_and_pairs(hot, pairs, d=24):
    """A large group of near copies, then pairs of near copies."""
    rng = np.random.RandomState(11)
    single = rng.randn(pairs, d)
    return graph_dedup.unit(np.vstack([
        rng.randn(1, d) + 0.02 * rng.randn(hot, d), np.repeat(single, 2, 0) + 0.02 * rng.randn(2 * pairs, d)]))


def one_by_one(x, lists, q, low, beam):
    """Nodes in range that a query finds, one expansion after the other."""
    met, expanded, turns = {graph_dedup.medoid(x)}, set(), 0
    similar = lambda v: float(np.einsum("d,d->", q, x[v]))
    while left := met - expanded:
        v = max(left, key=similar)
        if turns >= beam and similar(v) < low:
            break
        turns += 1
        expanded.add(v)
        met |= set(lists[v].tolist())
    return {v for v in met if similar(v) >= low}


@pytest.mark.parametrize("hot,pairs,beam", [(150, 40, 24), (150, 40, 3), (0, 60, 1), (1, 0, 24), (40, 0, 96), (2, 1, 2)])
def test_search_finds_what_one_expansion_after_the_other_finds(hot, pairs, beam):
    x = hot_and_pairs(hot, pairs)
    lists = graph_dedup.pruned_graph(x)
    queries = graph_dedup.unit(np.vstack([x, x[:40] + 0.01]))
    found = graph_dedup.search(x, lists, queries, 0.95, beam)
    for i in range(0, len(queries), 7):
        assert set(np.flatnonzero(found[i]).tolist()) == one_by_one(x, lists, queries[i], 0.95, beam)
    assert graph_dedup.search(x[:0], [], queries, 0.95, beam).shape == (len(queries), 0)
    assert graph_dedup.search(x, lists, queries[:0], 0.95, beam).shape == (0, len(x))


def test_equal_directions_and_nodes_without_neighbours():
    x = graph_dedup.unit(np.vstack([np.eye(6), 2 * np.eye(6), 8 * np.eye(6)]))
    assert graph_dedup.search(x, graph_dedup.pruned_graph(x), x, 0.95, 24).sum() == 18 * 3
    alone = [np.empty(0, np.int64)] * 6
    assert graph_dedup.search(x[:6], alone, x[:6], 0.95, 24).sum() == 1


def test_a_hot_group_is_expanded_in_few_rounds_with_bounded_memory(monkeypatch):
    """F3."""
    x = hot_and_pairs(1500, 50)
    lists, calls, real = graph_dedup.pruned_graph(x), [], graph_dedup.similarities
    monkeypatch.setattr(graph_dedup, "similarities", lambda *args: calls.append(1) or real(*args))
    tracemalloc.start()
    found = graph_dedup.search(x, lists, x[:graph_dedup.QUERIES], 0.95, graph_dedup.BEAM)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.sum() == (x[:graph_dedup.QUERIES] @ x.T >= 0.95).sum()
    assert len(calls) <= graph_dedup.BEAM + 20
    assert peak < 8 * 8 * graph_dedup.QUERIES * len(x)


def test_a_shard_with_a_hot_group_keeps_the_links_of_small_ones(monkeypatch):
    x = hot_and_pairs(400, 100)
    n, real = len(x), graph_dedup.search

    def lossy(nodes, lists, queries, low, beam):
        found = real(nodes, lists, queries, low, beam)
        found[(queries @ x[0] < low)] &= queries[queries @ x[0] < low] @ nodes.T > 1 - 1e-9
        return found

    monkeypatch.setattr(graph_dedup, "search", lossy)
    graph = graph_dedup._build(None, pd.DataFrame({"id": range(n), "v": list(x)}))
    rows = graph.assign(v=list(x), node=True, w=1, cells=[[0]] * n)
    got = graph_dedup._search(0.95)((24, 0, 0, 0), rows).sort_values("id")
    want = truth(x, range(n))
    assert [(a, b) for a, b in zip(got["links"], got["label"])] == [want[i] for i in range(n)]


def test_the_audit_of_the_table_counts_a_hot_group_once(spark):
    x = hot_and_pairs(400, 50)
    flat = spark.createDataFrame([(i, v.tolist(), 1, 24) for i, v in enumerate(x)], "id long, v array<double>, w long, d int")
    full = {i: links for i, (links, _) in truth(x, range(len(x))).items()}
    sums = lambda lost: spark.createDataFrame(
        [(i, 0 if i in lost else links) for i, links in full.items()], "id long, links long")
    assert graph_dedup.audit(flat, sums(()), 0.95) == 1.0
    assert graph_dedup.audit(flat, sums(range(400, 500)), 0.95) < graph_dedup.FLOOR
