"""The quadratic discriminant against a plain computation, and held-out accuracy."""

import os
import zlib

import numpy as np
import pytest
from helpers import by_id, docs
from pyspark.sql import functions as F

from qa_analytics.llm import quality_classifier as Q
from qa_analytics.llm.queries import op12_quality_classifier

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
LABELS = "doc_id long, quality int, toxic int"


def always(doc_id):
    return F.lit(True)


def fitted(rows, labels):
    """Scores by the definition, with solves instead of cached factors."""
    x = {i: np.array(Q.text_statistics(t or "")) for i, t in rows}
    train = {k: np.array([x[i] for i, q in labels if q == k]) for k in (0, 1)}
    n = {k: len(v) for k, v in train.items()}
    cov = {k: np.cov(v.T, bias=True) for k, v in train.items()}
    scale = np.sqrt(np.maximum((n[0] * np.diag(cov[0]) + n[1] * np.diag(cov[1])) / (n[0] + n[1]), 1e-12))
    out = {}
    for i, v in x.items():
        density = {}
        for k in (0, 1):
            s = (n[k] * cov[k] / np.outer(scale, scale) + 4 * Q.D * np.eye(Q.D)) / (n[k] + 4 * Q.D) + 1e-3 * np.eye(Q.D)
            z = (v - train[k].mean(axis=0)) / scale
            density[k] = -0.5 * (z @ np.linalg.solve(s, z) + np.linalg.slogdet(s)[1]) + np.log(n[k] / (n[0] + n[1]))
        out[i] = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    return out


def texts():
    good = [(i, f"The {w} walks home at night. It is {w}, and nobody minds!\nNext line here." * (1 + i % 4))
            for i, w in enumerate(("cat", "dog", "old man", "child", "bird", "fox") * 4)]
    bad = [(100 + i, ("BUY NOW!! $$$ " * (i + 2)) + "spam | " * (i % 5)) for i in range(12)]
    return good + bad + [(200, None), (201, ""), (202, "x" * 100000), (203, "\U0001F600 été 12")]


def test_scores_equal_the_definition(spark):
    rows = texts()
    labels = [(i, 1 if i < 100 else 0) for i, _ in rows if i < 200] + [(0, 0), (0, 1)]
    table = spark.createDataFrame(
        [(i, q, 0) for i, q in labels] + [(5, None, 0), (6, 7, 0), (None, 1, 0), (999, 0, 0)], LABELS)
    got = by_id(Q.classify(docs(spark, rows, stats="clash", learn="clash"), table, always))
    want = fitted(rows, labels)
    assert set(got) == set(want)
    for i, score in want.items():
        assert got[i]["score"] == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3) and not got[i]["held_out"]


def test_only_admitted_labels_are_learnt(spark):
    rows = texts()
    labels = [(i, int(i < 100)) for i, _ in rows if i < 200]
    train = lambda doc_id: F.crc32(doc_id.cast("string")) % 5 != 0
    frame = docs(spark, rows)
    aside = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    table = lambda flip: spark.createDataFrame([(i, 1 - q if flip and i in aside else q, 0) for i, q in labels], LABELS)
    one, two = (by_id(Q.classify(frame, table(flip), train)) for flip in (False, True))
    assert {i for i, r in one.items() if r["held_out"]} == aside and aside
    assert all(one[i]["score"] == pytest.approx(two[i]["score"], rel=1e-9, abs=1e-12) for i in one)


def test_missing_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    frame = docs(spark, [(1, "a b"), (1, "a b"), (2, None), (None, "c")])
    assert [r["score"] for r in Q.classify(frame, none, always).collect()] == [0.5] * 4
    ones = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert [r["score"] for r in Q.classify(frame, ones, always).collect()] == [1.0] * 4
    assert Q.classify(docs(spark, []), none, always).collect() == []


def test_held_out_accuracy(spark):
    scored = op12_quality_classifier(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    right = {k: [r["predicted"] == r["quality"] for r in rows if r["quality"] == k] for k in (0, 1)}
    assert len(rows) > 40 and all(sum(v) >= 0.95 * len(v) for v in right.values())
