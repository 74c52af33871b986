"""Training-text pipeline over the documents table: clean, deduplicate, mask, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again before the next; all but the last keep the columns of
`documents`.
"""

from pyspark.sql import functions as F

from qa_analytics.llm import minhash, mixing, packing, pii, quality
from qa_analytics.llm.common import own, read
from qa_analytics.session import durable


def _with_text(frame, docs, text):
    """The columns of `docs` from `frame`, with a new text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return frame.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the line-first rules, without their failing lines."""
    judged = quality.judge(docs)
    verdict, clean = own("quality", docs), own("clean_text", docs)
    return _with_text(judged.where(F.col(f"{verdict}.kept")), docs, F.col(clean))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the smallest id."""
    return minhash.without_duplicates(docs)


def personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by marks."""
    return _with_text(pii.mask(docs), docs, F.col("text"))


def source_mix(spark, docs, sf_dir):
    """Sources mixed to their target weights; a document comes as often as it is taken."""
    return mixing.mix(docs)


def length_packing(spark, docs, sf_dir):
    """The bucket, batch and place of every document of the mix."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("length_packing", length_packing),
]

# Hashes, classifiers and random rounding are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
