import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import by_id, docs

from qa_analytics.llm import pitman_yor as py
from qa_analytics.session import shared_folder


def rows(n=260):
    """Two kinds of text; in each the next word follows from the one before."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randrange(0, 60)):
            text.append(words[at])
            at = (at * 7 + 1) % 60 if rng.random() < 0.9 else rng.randrange(60)
        out.append((i, " ".join(text).title() if i % 9 == 0 else " ".join(text)))
    return out + [(n, None), (n + 1, "never seen words"), (3, out[3][1]), (3, out[3][1]), (None, "w1 w8")]


@pytest.fixture(scope="module")
def trained(spark):
    frame = docs(spark, rows(), key="x", score="y")
    aside = py.held_out(frame["doc_id"])
    return frame, *py.train(frame.where(~aside))


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def test_counts_and_base_scores(trained):
    frame, model, facts = trained
    aside = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
    seen = Counter(w for i, t in rows() if not aside(i) for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    assert (facts["N"], facts["V"]) == (n, v)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                 for r in py.score(frame, model, facts).collect())
    assert got == sorted(
        (str(i), len(tokens(t)), sum(w in seen for w in tokens(t)), n,
         round(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows())


def test_scores_do_not_depend_on_which_words_are_frequent(trained):
    frame, model, facts = trained
    many, few = (sorted((str(r.doc_id), r.score) for r in py.score(frame, model, facts, frequent=k).collect()) for k in (1000, 5))
    assert [x[0] for x in many] == [x[0] for x in few]
    assert max(abs(a[1] - b[1]) for a, b in zip(many, few)) < 1e-9


@pytest.mark.parametrize("which", ["trained", "by_word"])
def test_probabilities_of_every_context_sum_to_one(request, which):
    _, model, facts = request.getfixturevalue(which)
    words = {r.h: np.array(r.parents) for r in model.words.collect()}
    parents = sum(words.values()) + np.array(facts["unknown"])
    shares = Counter()
    for r in model.pairs.collect():
        shares[r.ctx] += r.share
    for r in model.contexts.collect():
        total = shares[r.ctx] / (facts["strength"] + r.customers) + (np.array(r.backs) * parents).mean()
        assert abs(total - 1) < 1e-9


def test_held_out_texts_score_better_than_the_base(spark, trained):
    frame, model, facts = trained
    scored = by_id(py.score(frame, model, facts))
    aside = [r for i, r in scored.items() if i is not None and zlib.crc32(str(i).encode()) % 5 == 1 and i < 260]
    assert sum(r.score for r in aside) > 0.8 * sum(r.base_score for r in aside)


def test_table_draws_follow_the_exact_law():
    d, c, others, chance = 0.6, 6, 10, 0.05
    log = py.stirling(py.EXACT, d)
    weight = np.array([log[c, t] + sum(math.log((1.0 + d * (others + j)) * chance) for j in range(t)) for t in range(1, c + 1)])
    law = np.exp(weight - weight.max())
    law /= law.sum()
    n = 40_000
    t = py.draw_tables(np.full(n, c), np.full(n, others), d, 1.0, np.full(n, chance), np.random.default_rng(1), log)
    assert np.allclose(np.bincount(t, minlength=c + 1)[1:] / n, law, atol=0.01)
    large = py.draw_tables(np.full(4000, 500), np.full(4000, others), d, 1.0, np.full(4000, chance), np.random.default_rng(1), log)
    assert 1 <= large.min() and large.max() <= 500


class Restaurants:
    """The same model with every customer in a seat of its own, reseated one by one."""

    def __init__(self, corpus, d0, d1, strength, seed):
        self.rng, self.d, self.strength = random.Random(seed), (d0, d1), strength
        self.customers = [(ctx, w) for text in corpus for ctx, w in zip([b"", *text], text)]
        self.v = len({w for _, w in self.customers})
        self.seats, self.parent = {}, {}  # (ctx, dish) -> table sizes; dish -> table sizes
        self.totals, self.whole = Counter(), Counter()
        for ctx, w in self.customers:
            self.sit(ctx, w)

    def top(self, w):
        sizes, n = self.parent.get(w, []), sum(self.whole.values())
        own = max(sum(sizes) - self.d[0] * len(sizes), 0)
        served = sum(map(len, self.parent.values()))
        return (own + (self.strength + self.d[0] * served) / (self.v + 1)) / (self.strength + n)

    def opened(self, ctx):
        return self.totals[ctx, "tables"]

    def chance(self, ctx, w):
        sizes = self.seats.get((ctx, w), [])
        own = sum(sizes) - self.d[1] * len(sizes)
        return (own + (self.strength + self.d[1] * self.opened(ctx)) * self.top(w)) / (self.strength + self.totals[ctx])

    def choose(self, sizes, d, new):
        """A table with weight size - d, or a new one."""
        at = self.rng.choices(range(len(sizes) + 1), [x - d for x in sizes] + [new])[0]
        if at == len(sizes):
            sizes.append(0)
        sizes[at] += 1
        return sizes[at] == 1

    def sit(self, ctx, w):
        new = (self.strength + self.d[1] * self.opened(ctx)) * self.top(w)
        self.totals[ctx] += 1
        if self.choose(self.seats.setdefault((ctx, w), []), self.d[1], new):
            self.totals[ctx, "tables"] += 1
            served = sum(map(len, self.parent.values()))
            self.choose(self.parent.setdefault(w, []), self.d[0], (self.strength + self.d[0] * served) / (self.v + 1))
            self.whole[w] += 1

    def stand(self, sizes):
        at = self.rng.choices(range(len(sizes)), sizes)[0]
        sizes[at] -= 1
        if not sizes[at]:
            del sizes[at]
            return True
        return False

    def sweep(self):
        for ctx, w in self.customers:
            self.totals[ctx] -= 1
            if self.stand(self.seats[ctx, w]):
                self.totals[ctx, "tables"] -= 1
                self.whole[w] -= 1
                self.stand(self.parent[w])
            self.sit(ctx, w)


def test_scores_equal_a_plain_sequential_sampler(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    texts = []
    for _ in range(60):
        at, text = rng.randrange(12), []
        for _ in range(rng.randrange(1, 12)):
            text.append(words[at])
            at = (at * 5 + 1) % 12 if rng.random() < 0.8 else rng.randrange(12)
        texts.append(" ".join(text))
    asked = [*texts[:25], "w1 w1 w1", "w3 nothing w4", "", "w0 w1 w6 w7 w0"]
    frame = docs(spark, [*enumerate(texts), *((100 + i, t) for i, t in enumerate(asked))])
    model, facts = py.train(frame.where("doc_id < 100"), burn_in=4, samples=6)
    got = by_id(py.score(frame.where("doc_id >= 100"), model, facts, frequent=20))
    plain = Restaurants([tokens(t) for t in texts], facts["d0"], facts["d1"], facts["strength"], 3)
    pairs = {(c, w) for t in asked for c, w in zip([b"", *tokens(t)], tokens(t))}
    chance, kept = Counter(), 60
    for k in range(20 + kept):
        plain.sweep()
        if k >= 20:
            for c, w in pairs:
                chance[c, w] += plain.chance(c, w) / kept
    for i, t in enumerate(asked):
        want = sum(math.log10(chance[c, w]) for c, w in zip([b"", *tokens(t)], tokens(t)))
        assert abs(got[100 + i].score - want) < 0.04 * len(tokens(t)), t


@pytest.mark.parametrize("c, chance", [(150, 0.0002), (150, 0.01), (150, 0.2), (1500, 0.003), (1500, 0.1)])
def test_draws_for_many_customers_are_close_to_the_exact_law(c, chance):
    """Above `EXACT` customers the law is taken in continuous time."""
    d, others, n = 0.6, 40, 20_000
    log = py.stirling(c, d)
    t = np.arange(1, c + 1)
    weight = log[c, 1:] + np.cumsum(np.log(1.0 + d * (others + t - 1)) + math.log(chance))
    law = np.exp(weight - weight.max())
    law /= law.sum()
    mean = (law * t).sum()
    drawn = py.draw_tables(np.full(n, c), np.full(n, others), d, 1.0, np.full(n, chance), np.random.default_rng(2), log)
    share = np.bincount(drawn, minlength=c + 1)[1:c + 1] / n
    print("tables by the law", mean, "drawn", drawn.mean(), "distance", abs(share - law).sum() / 2)
    assert abs(drawn.mean() - mean) < 0.02 * mean
    assert abs(share - law).sum() / 2 < 0.04
    keyed = py.Keyed(np.arange(n, dtype=np.uint64))
    again = py.draw_tables(np.full(n, c), np.full(n, others), d, 1.0, np.full(n, chance), keyed, log)
    assert abs(again.mean() - mean) < 0.02 * mean


def test_empty_tables(spark):
    frame = docs(spark, [(1, "a b"), (2, None)])
    model, facts = py.train(frame.limit(0))
    got = by_id(py.score(frame, model, facts))
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[2].n_tokens) == (3, 0, 0, 1)
    assert py.score(frame.limit(0), model, facts).count() == 0


@pytest.fixture(scope="module")
def by_word(spark):
    """600 words, each with one successor of its own."""
    rng = random.Random(4)
    texts = [" ".join(f"v{(at + 7 * j) % 600}" for j in range(40)) for at in (rng.randrange(600) for _ in range(300))]
    frame = docs(spark, [*enumerate(texts), (300, "v1 v8 v15 new v22"), (301, None), (5, texts[5]), (302, "v8 v1 v3")])
    return frame, *py.train(frame.where("doc_id < 300"))


def test_every_word_is_a_context_of_its_own(by_word):
    frame, model, facts = by_word
    scored = by_id(py.score(frame, model, facts))
    assert model.contexts.count() == 601
    assert np.mean([scored[i].score / scored[i].n_tokens for i in range(300)]) > -0.25
    assert scored[302].score / scored[302].n_tokens < -2


def test_scores_by_word_do_not_depend_on_which_pairs_are_frequent(by_word):
    frame, model, facts = by_word
    many, few = (sorted((r.doc_id, r.n_known, r.base_score, r.score) for r in py.score(frame, model, facts, frequent=k).collect())
                 for k in (5000, 7))
    assert [x[:2] for x in many] == [x[:2] for x in few]
    assert max(abs(a[i] - b[i]) for a, b in zip(many, few) for i in (2, 3)) < 1e-9


@pytest.fixture(scope="module")
def few_numbered(spark):
    """The texts of `trained`, with most words known by their hash."""
    frame = docs(spark, rows(), key="x", score="y")
    return frame, *py.train(frame.where(~py.held_out(frame["doc_id"])), near=12)


def test_scores_do_not_depend_on_which_words_are_numbered(trained, few_numbered):
    frame, model, facts = trained
    _, other, others = few_numbered
    assert 0 < others["near"] <= 12 < facts["near"]
    a, b = (sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                   for r in py.score(frame, m, f, frequent=k).collect()) for m, f, k in ((model, facts, 1000), (other, others, 3)))
    assert [x[:4] for x in a] == [x[:4] for x in b]
    for x, y in zip(a, b):
        assert abs(x[4] - y[4]) < 1e-9 and abs(x[5] - y[5]) < 1e-9
    again = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                   for r in py.score(frame, other, others, frequent=1000).collect())
    assert max(abs(x[5] - y[5]) for x, y in zip(b, again)) < 1e-9


def test_probabilities_with_few_numbered_words_sum_to_one(request):
    test_probabilities_of_every_context_sum_to_one(request, "few_numbered")


def test_tables_of_a_sweep_are_gone_when_training_ends(spark):
    """Only the pairs, the last seats, the words and the contexts stay on the disk."""
    def tables():
        folder = shared_folder(spark).removeprefix("file:")
        return {x for x in os.listdir(folder) if x.startswith("qa-step-")} if os.path.isdir(folder) else set()

    before = tables()
    model, _ = py.train(docs(spark, [(1, "a b a b c"), (2, "a b d")]))
    assert len(tables() - before) == 4
    assert model.words.count() == 5


def test_tokens_of_arrow_texts_are_those_of_plain_splitting():
    texts = ["", None, " a  B\ta\n", "\x0b\x0c\r", "Ä é x \x1f\x1c q", "b a", "end"]
    hashes, numbers, before, text = py._tokens(py.pa.array(texts))
    want = [[py.xxhash.xxh3_64_intdigest(w) for w in tokens(t)] for t in texts]
    assert hashes[numbers].tolist() == sum(want, [])
    assert text.tolist() == [i for i, t in enumerate(want) for _ in t]
    assert hashes[before].tolist() == [h for t in want for h in [hashes[0], *t[:-1]]]


def test_pairs_are_counted_in_packed_parts(spark):
    """One row per part and kind, whatever the number of pairs: no row per pair is moved."""
    frame = docs(spark, rows(60), key="x", score="y")
    model, facts = py.train(frame, near=12)
    seen = Counter(p for _, t in rows(60) for p in zip(tokens(t), [b"", *tokens(t)]))
    packed = model.counted.collect()
    assert len({(r.part, r.kind) for r in packed}) == len(packed) <= 2 * facts["parts"]
    hashed = {tuple(py.xxhash.xxh3_64_intdigest(w) for w in p): n for p, n in seen.items()}
    names = facts["codes"].value
    plain = lambda code: int(names[code]) if 0 <= code < facts["near"] else code % 2 ** 64
    assert {(plain(r.h), plain(r.ctx)): r.c for r in model.pairs.collect()} == hashed
