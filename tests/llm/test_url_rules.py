import re

from pyspark.sql import functions as F

from qa_analytics.llm import url_rules

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))
URLS = [
    None, "", "no scheme", "http://", "http://A.com", "http://a.COM/", "ftp://x.example.com/en/1?q=1#t", "https://www.example.com/en/",
    "https://notexample.com/en/x", "http://net/es/", "http://bnet/es/", "http://b.net/es?x", "a://b://c.com/d", "http://é.com/É?", "x://h:80/p",
]


def plain(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(1, URLS[5], "x")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_rules.judge(pages, labels, RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) in [plain(URLS[r.page_id]), plain(URLS[5])]
    assert url_rules.judge(pages.limit(0), labels, RULES).count() == 0


def brute_rules(rows, support, confidence, most):
    """All token combinations that lead to a bad label often enough, less those a smaller one covers."""
    from itertools import combinations
    found = {}
    for tokens, _ in rows:
        for k in range(1, most + 1):
            for c in combinations(sorted(tokens), k):
                found.setdefault(c, [0, 0])
    share = sum(bad for _, bad in rows) / len(rows)
    for c, n in found.items():
        hits = [bad for tokens, bad in rows if set(c) <= set(tokens)]
        n[:] = [sum(hits), len(hits)]
    rules = {c: a / b for c, (a, b) in found.items() if a / len(rows) >= support and a / b >= confidence and a / b > share}
    return {c: v for c, v in rules.items()
            if not any(rules.get(p, 0) >= v for k in range(1, len(c)) for p in combinations(c, k))}


def test_mined_rules_equal_brute_force(spark):
    urls = [(f"http://{h}.org/{lang}/{i}{tail}", h == "spam" or (lang == "fr" and tail == "?ref=1") or i % 11 == 0)
            for i in range(25) for h in ("spam", "good", "news") for lang, tail in (("fr", "?ref=1"), ("en", "?ref=1"), ("fr", ""))]
    table = spark.createDataFrame(urls, "url string, bad boolean")
    tokens = [(r.t, r.bad) for r in table.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    got = {tuple(r.tokens): r.confidence for r in url_rules.mine(table, 0.05, 0.6, 3).collect()}
    want = brute_rules(tokens, 0.05, 0.6, 3)
    assert set(got) == set(want) and all(abs(got[c] - want[c]) < 1e-9 for c in got)
    pages = table.select(F.monotonically_increasing_id().alias("page_id"), "url")
    labels = pages.join(table, "url").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("quality"), F.col("bad").cast("int").alias("toxic"))
    judged = url_rules.judge(pages, labels, (), min_support=0.05, min_confidence=0.6)
    for r in judged.join(pages, "page_id").collect():
        has = set(spark.createDataFrame([(r.url,)], "url string").select(url_rules.tokens_of(F.col("url"))).first()[0]) if r.mined is None else None
        if r.mined is None:
            assert r.verdict == "allow" and not any(set(c) <= has for c in want)
            break
    found = {r.url: r.verdict for r in judged.join(pages, "page_id").select("url", "verdict").collect()}
    hit = {u for (u, _), (t, _) in zip(urls, tokens) if any(set(c) <= set(t) for c in want)}
    assert {u for u, v in found.items() if v == "block"} == hit


def test_long_urls_and_few_labels_end_soon(spark):
    import time
    start = time.time()
    long = "http://x.org/" + "/".join(f"w{i}x" for i in range(200))
    few = [(f"http://h{i}.org/a/b", i % 2 == 0) for i in range(10)]
    assert url_rules.mine(spark.createDataFrame([*few, (long, True)], "url string, bad boolean")).count() == 0
    # As many copies as a rule needs: every token of the long URL is a rule of its own, and no two together.
    rules = url_rules.mine(spark.createDataFrame([*few, *[(long, True)] * 6], "url string, bad boolean")).collect()
    assert {t for r in rules for t in r.tokens} >= {f"path:w{i}x" for i in range(200)} and all(len(r.tokens) == 1 for r in rules)
    pages = spark.createDataFrame([(i, long) for i in range(6)] + [(7, long + "/" + "z" * 50_000), (8, few[0][0])], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i in range(6)] + [(8, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages, labels, ()).collect()}
    assert got[7] == "block" and got[8] == "allow" and time.time() - start < 60


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert url_rules.judge(pages, labels, RULES).collect() == []


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0, 1), (1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    plan = url_rules.judge(pages, labels, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
