"""Spelling variants against brute force over all pairs, at several numbers of symbols and with split buckets."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import docs

from qa_analytics.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == (b[i:] if len(a) > len(b) else b[i + 1:])


def plain(rows):
    low, count = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += len(run) > 6
    words = {w: n for w, n in count.items() if n > 1}
    nears = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in nears.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(nears[w]), words[form[w]] if w in form else None)
    return out


def found(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def corpus(seed):
    rng = random.Random(seed)
    letters = "abiéÀ×z"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(25)] + ["aaaaaaaaaa"]
    rows = [(None, None), (1, ""), (1, "  12 .. ,"), (7, "b" * 3000 + " " + "b" * 3000 + "c")]
    for doc_id in range(60):
        words = []
        for _ in range(60):
            w = rng.choice(base[:6] if rng.random() < 0.6 else base)
            p = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.1:
                w = w[:p] + w[p + 1:]
            elif kind < 0.2:
                w = w[:p] + rng.choice(letters) + w[p + 1:]
            elif kind < 0.3:
                w = w[:p] + rng.choice(letters) + w[p:]
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((doc_id % 50, " ".join(words)))
    return rows + [rows[-1]] * 12


@pytest.mark.parametrize("symbols, bucket", [(None, S.BUCKET), (4, 1), (2, 3), (256, 1)])
def test_variants_equal_brute_force(spark, symbols, bucket):
    rows = corpus(3)
    want = plain(rows)
    assert any(f for f, *_ in want.values()) and sum(n for *_, n, _ in want.values()) > 100
    frame = docs(spark, rows, word="clash", n="clash")
    assert found(S.variants(frame, symbols=symbols, bucket=bucket)) == want


def test_chain_of_forms_leads_to_the_last(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4")], "word string, form string")
    got = {r["word"]: r["root"] for r in S.roots(links).collect()}
    assert got == {**{f"w{i}": "w9" for i in range(9)}, "x": "w9"}


def test_keys_of_neighbours_are_those_of_edited_words():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgzé") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    for k in (4, 256):
        made = {(words[r], int(key)) for rows, keys, _ in S.neighbour_keys(words, k) for r, key in zip(rows, keys)}
        for w in words:
            for i in range(len(w)):
                if len(w) > 1:
                    assert (w, int(S.reduced_keys([w[:i] + w[i + 1:]], k)[0])) in made


def test_number_of_symbols_grows_with_the_vocabulary():
    assert [S.symbols_for(n) for n in (0, 10, 10**4, 10**6, 10**9, 10**30)] == [4, 4, 4, 4, 10, 256]


def test_no_words(spark):
    assert S.variants(docs(spark, [])).collect() == []
    assert S.variants(docs(spark, [(1, "short words only"), (2, None)])).collect() == []
