import random
import re
from collections import Counter

from helpers import docs
from pyspark.sql import functions as F

from qa_analytics.llm import quality


def base(text):
    """Base counts worked out plainly."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def judged(spark, rows, **extra):
    return quality.judge(docs(spark, rows, **extra))


def test_base_counts_equal_a_plain_count(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c a b c a b c"), (6, "é\x0bü\x0c日本\rx\n日本\n日本")]
    for i in range(7, 120):
        words = [rng.choice(["ab", "c", "d|", "é#", "x"]) for _ in range(rng.randrange(1, 90))]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", "  ", "\t"]) for w in words)))
    rows += rows[5:8]
    got = judged(spark, rows).collect()
    assert len(got) == len(rows)
    for r in got:
        q = r["quality"]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base(r["text"]), r["text"]
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)


def prose(n, start=0):
    return "\n".join(" ".join(f"word{start + 10 * i + j}" for j in range(10)) + "." for i in range(n))


def test_lines_are_judged_before_documents(spark):
    good, menu = prose(8), "Home | News | Sport | Weather | About | Contact"
    rows = [
        (1, good), (2, menu + "\n" + good + "\nAll rights reserved."), (3, "\n".join([f"x{i} | y{i} | z{i} | q{i}" for i in range(40)])),
        (4, prose(6) + "\n" + "\n".join(f"{w}***" * 4 + " %%% ### $$$" for w in ("spam", "ham")) + "\n" + prose(6, 500)),
        (5, (prose(2) + "\n") * 3 + prose(2)), (6, good.replace("\n", "\n\n")),
    ]
    got = {r["doc_id"]: r for r in judged(spark, rows).collect()}
    assert {i for i, r in got.items() if r["quality"].kept} == {1, 2, 4, 6}
    assert got[1]["clean_text"] == good
    assert got[2]["clean_text"] == good
    assert "spam" not in got[4]["clean_text"] and "word500" in got[4]["clean_text"]
    assert got[6]["clean_text"] == good.replace("\n", "\n\n")


def test_clashing_columns_and_empty_tables(spark):
    out = judged(spark, [(1, prose(9))], quality="mine", t="t", w="w")
    assert out.columns[-2:] == ["_quality", "clean_text"]
    assert out.first()["quality"] == "mine"
    assert judged(spark, [(1, "x")]).limit(0).count() == 0
    assert quality.judge(docs(spark, [(1, "x")]).where(F.lit(False))).count() == 0


def test_plan_has_no_python_and_no_exchange(spark):
    plan = judged(spark, [(1, "x")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
