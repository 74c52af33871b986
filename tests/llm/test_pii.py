import hashlib
import re
from collections import Counter

import numpy as np
from helpers import docs
from pyspark.sql import functions as F

from qa_analytics.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    spans = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s[2] for s in sorted(spans))


TEXTS = [
    None, "", "no data here.", "a@b.co_d@e.fr x@y.z.. @no.com a@b a%+b@c-d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and 4111  1111 1111 1111", "+1 (555) 010-9999. +12 +1 2 +4412345678901234567",
    "é" * 50 + " jo.do@mail.example.com" * 700, "0" * 40 + " " + "49927398716" * 2, "+49 30 123456 10.0.0.1@host.net 555-123-4567",
]


def test_base_spans_equal_plain_regular_expressions(spark):
    found = pii.candidates(docs(spark, list(enumerate(TEXTS)), found="clash", sure="x"), name="spans")
    sure = pii.listing(F.filter("spans", lambda x: x["base"]))
    rows = found.select("doc_id", sure.alias("b"), F.sha2(sure, 256).alias("h")).collect()
    for r in rows:
        assert r.b == base(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert r.h == hashlib.sha256(base(TEXTS[r.doc_id]).encode()).hexdigest()


def test_loose_spans_need_support(spark):
    many = [(i, f"Mail me at user{i}@host{i}.com or call +1 555 010 {1000 + i}.") for i in range(200)]
    many += [(300 + i, f"contact: user{i} [at] site [dot] com, phone (555) 123-{1000 + i}.") for i in range(20)]
    many += [(400 + i, f"order no. 12 345 {1000 + i} in section 555 123 {2000 + i}.") for i in range(20)]
    found = pii.candidates(docs(spark, many))
    weights = pii.fit(found)
    kept = found.select("doc_id", pii.listing(pii.accepted(weights)).alias("s")).collect()
    assert all(r.s.count("email") == 1 and r.s.count("phone") == 1 for r in kept if r.doc_id < 400)
    assert all(r.s == "" for r in kept if r.doc_id >= 400)


def test_em_equals_a_plain_version():
    """Every span on its own, with arrays, in place of counts per pattern."""
    rng = np.random.RandomState(3)
    truth, base = rng.rand(900) < 0.4, rng.rand(900) < 0.2
    truth |= base
    kinds = rng.randint(0, 2, 900)
    votes = np.stack([np.where(rng.rand(900) < right, np.where(truth, 1, -1), rng.randint(-1, 2, 900)) for right in (0.9, 0.6, 0.3, 0.1)], 1)
    patterns = Counter((pii.KINDS[k], bool(b), *map(int, v)) for k, b, v in zip(kinds, base, votes))
    patterns = sorted((*x, n) for x, n in patterns.items())
    got = dict(zip((x[:6] for x in patterns), pii.expectation_maximisation(patterns, 12)))
    q = np.where(base, 1.0, 1 / (1 + np.exp(-1.5 * (votes.sum(1) - 0.5))))
    for _ in range(12):
        odds = np.zeros(900)
        for k in (0, 1):
            mine = (kinds == k) & ~base
            odds[kinds == k] = np.log((1 + q[mine].sum()) / (1 + (1 - q[mine]).sum()))
        for j in range(4):
            for v in (-1, 0, 1):
                at = votes[:, j] == v
                odds[at] += np.log((1 + q[at].sum()) / (3 + q.sum())) - np.log((1 + (1 - q)[at].sum()) / (3 + (1 - q).sum()))
        q = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
    for k, b, v, x in zip(kinds, base, votes, q):
        assert abs(got[(pii.KINDS[k], bool(b), *map(int, v))] - x) < 1e-9
    proposed = ~base
    assert ((q > 0.5) == truth)[proposed].mean() > 0.9


def test_the_classifier_sees_more_than_the_votes(spark):
    """Spans with the same votes are told apart by the words beside them; scores equal plain sums."""
    rows = [(i, f"call me on (555) 123-{1000 + i} tonight.") for i in range(60)]
    rows += [(100 + i, f"invoice part 555 123 {2000 + i} enclosed.") for i in range(60)]
    rows += [(200 + i, f"ask for 555 123 {3000 + i} tonight.") for i in range(3)]
    rows += [(300 + i, f"see part 555 123 {3000 + i} enclosed.") for i in range(3)]
    found = pii.candidates(docs(spark, rows)).select("doc_id", "found").cache()
    weights, places = pii.fit(found), pii._vote_places()
    scores, kept = {}, {r.doc_id: r.s for r in found.select("doc_id", pii.listing(pii.accepted(weights)).alias("s")).collect()}
    for r in found.collect():
        x, = r.found
        scores[r.doc_id] = sum(weights[i] for i in x.seen) + weights[places[x.kind]] + sum(
            weights[places[x.kind, v, x.votes[v]]] for v in pii.LABELERS)
        assert (kept[r.doc_id] != "") == (scores[r.doc_id] > 0)
    assert min(scores[i] for i in range(60)) > 0 > max(scores[100 + i] for i in range(60))
    assert min(scores[200 + i] for i in range(3)) > max(scores[300 + i] for i in range(3)) + 0.1
    assert pii.fit(found) == weights and pii.fit(found.limit(0)) == []


def test_mask_replaces_spans_only(spark):
    frame = docs(spark, [(1, "Write to jo@ex.com, 10.0.0.1 é +1 555 010 9999!"), (2, None), (3, "clean text.")], found="f")
    out = {r.doc_id: r for r in pii.mask(frame).collect()}
    assert out[1].text == "Write to [EMAIL], [IP] é [PHONE]!"
    assert (out[2].text, out[3].text, out[1].found) == (None, "clean text.", "f")
    assert pii.mask(frame.limit(0)).count() == 0 and pii.mask(frame).columns == frame.columns


def test_plan_has_no_python(spark):
    assert "Python" not in pii.candidates(docs(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()


def test_long_runs_stay_linear(spark):
    text = "a" * 300_000 + " " + "1." * 100_000 + " " + "7" * 200_000
    assert pii.candidates(docs(spark, [(1, text)])).select(F.size("found")).first()[0] == 25_000
