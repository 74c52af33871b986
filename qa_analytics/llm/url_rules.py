"""URL verdicts: fixed host and path rules first, association rules mined from labels for the rest.

Host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower
case; path goes on up to `?`, `#` or the end; both are empty for null or without
`://`. A fixed rule fits its host and all subdomains if the path starts with the
rule's path; the longest wins.

For all other URLs, FP-growth runs over the labelled ones: their items are host
parts, path segments (numbers as one item), file ending and query keys, plus
one item for a bad label. Combinations that lead to it with enough support and
confidence are rules; a rule that a smaller one covers with the same confidence
or more is dropped (of rules with equal confidence the one with fewer tokens
stays, those with as many stay side by side). Rules are matched by an inverted index: each is filed under
its rarest token, URLs are looked up by their tokens, and the other tokens are
compared for the rules found. A URL with a matching rule is blocked.

Built-in expressions and Spark's own FP-growth only. Items are bounded by the
support threshold; equal URLs are matched once. Ties between rules that fit go
to the larger support, then to the last rule in order. Null labels say nothing, a
page with several labels is bad if one is; without labels or rules every URL
is allowed. Repeated pages get a row each; other columns are ignored.
"""

from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .common import lower_ascii

BAD = "label:bad"
# Labelled rows that a rule needs at least.
MIN_ROWS = 5


def host_of(url):
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url):
    """Distinct tokens of a URL: host parts, path segments, file ending and query keys."""
    def tagged(tag, parts):
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    host, path = host_of(url), lower_ascii(path_of(url))
    segments = F.transform(F.split(path, r"[/.\-_]+"), lambda x: F.regexp_replace(x, "^[0-9]+$", "#"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        tagged("host:", F.split(host, r"[.\-:@]+")), tagged("path:", segments),
        tagged("query:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)))))


def fixed_rule(host, path, rules):
    """(rule, verdict) of the longest of `rules` (verdict, host, path) that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def _alike(seen: DataFrame) -> DataFrame:
    """(token, alike): tokens with the same labelled rows get the same smallest token; `seen` has row and has.

    Such tokens make equal rules, so one of them stands for all while rules are
    mined. Sets of rows are told apart by their sizes and two sums of hashes.
    """
    rows = seen.select("row", F.explode("has").alias("token"))
    marked = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("s"),
        F.sum(F.xxhash64("row", F.lit("again")).cast("decimal(38,0)")).alias("z"))
    return durable(marked.join(
        marked.groupBy("n", "s", "z").agg(F.min("token").alias("alike")), ["n", "s", "z"]).select("token", "alike", "n"))


def mine(labelled: DataFrame, min_support=0.005, min_confidence=0.7, max_tokens=3, min_rows=MIN_ROWS) -> DataFrame:
    """(tokens, confidence, support) of the rules for bad URLs; `labelled` has url and bad (boolean).

    A rule needs `min_rows` labelled rows as well as its support, and tokens
    that always occur together are mined as one, so neither a small table nor
    one long URL makes FP-growth enumerate all combinations of its tokens.
    """
    seen = durable(labelled.select(
        F.monotonically_increasing_id().alias("row"), tokens_of(F.col("url")).alias("has"), "bad"))
    support = min(1.0, max(min_support, min_rows / max(seen.count(), 1)))
    alike = _alike(seen)
    frequent = alike.where(F.col("n") >= min_rows)
    kept = seen.select("row", F.explode("has").alias("token")).join(frequent, "token").groupBy("row").agg(
        F.collect_set("alike").alias("tokens"))
    items = F.concat(F.coalesce("tokens", F.array().cast("array<string>")),
                     F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(
        durable(seen.select("row", "bad").join(kept, "row", "left").select(items.alias("items"))))
    found = durable(model.associationRules.where(
        (F.col("consequent")[0] == BAD) & (F.size("antecedent") <= max_tokens) & (F.col("lift") > 1)
    ).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    # Every token that is mined as another takes its place in turn.
    rules = found
    others = alike.where("token != alike").groupBy("alike").agg(F.collect_list("token").alias("more"))
    for place in range(max_tokens):
        rules = rules.withColumn("alike", F.get("tokens", F.lit(place))).join(others, "alike", "left").select(
            F.explode(F.concat(F.array("alike"), F.coalesce("more", F.array().cast("array<string>")))).alias("token"),
            "tokens", "confidence", "support").select(
            F.when(F.col("token").isNull(), F.col("tokens")).otherwise(F.transform(
                "tokens", lambda t, i: F.when(i == place, F.col("token")).otherwise(t))).alias("tokens"), "confidence", "support")
    rules = durable(rules.select(F.array_sort("tokens").alias("tokens"), "confidence", "support"))
    # Parts of a rule that are rules themselves, found by their exact tokens.
    places = [c for k in range(1, max_tokens) for c in combinations(range(max_tokens), k)]
    parts = rules.select("tokens", "confidence", F.explode(F.array(*(
        F.filter("tokens", lambda x, i: i.isin(*chosen)) for chosen in places))).alias("part")).where(
        (F.size("part") > 0) & (F.size("part") < F.size("tokens"))).distinct()
    covered = parts.join(
        rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("of_part")), "part"
    ).where("of_part >= confidence").select("tokens").distinct()
    return durable(rules.join(covered, "tokens", "left_anti"))


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule) of each distinct url that a rule fits: the most confident rule, its tokens joined by +."""
    seen = durable(urls.distinct().select("url", tokens_of(F.col("url")).alias("has")))
    filed = rules.select(F.explode("tokens").alias("token")).distinct()
    # How often the tokens in rules occur decides where each rule is filed.
    counts = seen.select(F.explode("has").alias("token")).groupBy("token").count().join(filed, "token", "left_semi")
    index = durable(rules.select("*", F.explode("tokens").alias("token")).join(durable(counts), "token").groupBy(
        "tokens", "confidence", "support").agg(F.min(F.struct("count", "token")).alias("rare")).select(
        F.col("rare.token").alias("token"), "tokens", "confidence", "support"))
    met = seen.select("url", "has", F.explode("has").alias("token")).join(index, "token").where(
        F.size(F.array_except("tokens", "has")) == 0)
    return met.groupBy("url").agg(F.max(F.struct("confidence", "support", F.array_join("tokens", "+").alias("rule"))).alias("best")).select(
        "url", F.col("best.rule").alias("mined"))


def judge(pages: DataFrame, labels: DataFrame, rules, id="page_id", url="url", label_id="doc_id", bad=None, **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined): one row per row of `pages`; `mined` is the association rule that fits."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)) if bad is None else bad
    pages = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"))
    said = labels.select(F.col(f"`{label_id}`").alias("id"), bad.alias("bad"), F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    said = said.toDF("id", "bad", "known").where("known").groupBy("id").agg(F.max("bad").alias("bad"))
    mined = mine(pages.join(said, "id").select("url", "bad"), **limits)
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    seen = pages.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select(
        "*", rule.alias("rule"), verdict.alias("verdict"))
    matched = durable(matching(seen.where("rule is null and host != ''").select("url"), mined))
    return seen.join(matched, "url", "left").select(
        F.col("id").alias(id), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))
