"""The text operators applied to their whole tables, with production parameters."""

import public_tokenizers

from pyspark.sql import functions as F

from . import (
    graph_dedup, html_text, minhash, mixing, packing, pii, pitman_yor, quality, quality_classifier, spelling, token_counts,
    turn_repair, url_rules,
)
from ..session import durable
from .common import read
from .oracle import ORACLE_SQL  # noqa: F401

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_length_packing(spark, d):
    return packing.pack(read(spark, d, "documents"))


@query
def op2_source_mix(spark, d):
    return mixing.taken(read(spark, d, "documents"))


@query
def op3_html_text(spark, d):
    return html_text.extract(read(spark, d, "pages"))


URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query
def op4_url_rules(spark, d):
    return url_rules.judge(read(spark, d, "pages"), read(spark, d, "labels"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op5_token_counts(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


@query
def op6_graph_near_dedup(spark, d):
    return graph_dedup.near_duplicates(read(spark, d, "embeddings"))


@query
def op7_pitman_yor(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    aside = pitman_yor.held_out(F.col("doc_id"))
    model, facts = pitman_yor.train(docs.where(~aside))
    return pitman_yor.score(docs, model, facts).select(
        "doc_id", aside.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_personal_data(spark, d):
    found = durable(pii.candidates(read(spark, d, "documents")).select("doc_id", "found"))
    weights = pii.fit(found)
    base = F.filter("found", lambda x: x["base"])
    return found.select(
        "doc_id", *(F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.listing(base), 256).alias("base_sha256"), pii.listing(pii.accepted(weights)).alias("spans"))


@query
def op9_quality_rules(spark, d):
    judged = quality.judge(read(spark, d, "documents"))
    return judged.select("doc_id", *(f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


@query
def op10_minhash_near_dedup(spark, d):
    return minhash.near_duplicates(read(spark, d, "documents"), words=3, percent=85)


@query
def op11_spelling_variants(spark, d):
    return spelling.variants(read(spark, d, "documents"))


@query
def op12_quality_classifier(spark, d):
    return quality_classifier.classify(
        read(spark, d, "documents"), read(spark, d, "labels"),
        lambda doc_id: F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0)


@query
def op13_turn_repair(spark, d):
    rows = read(spark, d, "conversations")
    return turn_repair.repair(turn_repair.damage(rows), rows)
