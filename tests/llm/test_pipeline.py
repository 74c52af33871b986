import corpus_pipeline
from helpers import docs

from qa_analytics.session import durable

def prose(seed, n=8):
    return "\n".join(" ".join(f"s{seed}w{10 * i + j}" for j in range(10)) + "." for i in range(n))

def table(spark):
    rows = [(i, prose(i) + f"\nWrite to user{i}@host.com or +1 555 010 {1000 + i}.", "ab"[i % 2]) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " Extra.", "c") for i in range(10)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "short text.", "a"), (203, "x | y | z | q | r | s\n" * 30, None)]
    rows += [(0, rows[0][1], "a")]
    return docs(spark, rows, quality="own", text2="y")

def test_each_stage_takes_effect_and_keeps_the_columns(spark):
    frame = table(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "personal_data", "source_mix", "length_packing"]
    now, seen = frame, {}
    for name, stage in corpus_pipeline.STAGES:
        now = durable(stage(spark, now, ""))
        seen[name] = now
        if name != names[-1]:
            assert now.columns == frame.columns
    kept = {r.doc_id for r in seen["quality_rules"].collect()}
    assert kept == {*range(40), *range(100, 110)}
    assert sorted(r.doc_id for r in seen["minhash_near_dedup"].collect()) == list(range(40))
    masked = seen["personal_data"].collect()
    assert all("[EMAIL]" in r.text and "[PHONE]" in r.text and "@" not in r.text for r in masked)
    assert all(r.n_chars == len(r.text) and r.quality == "own" for r in masked)
    mixed = [r.doc_id for r in seen["source_mix"].collect()]
    assert set(mixed) <= set(range(40)) and max(map(mixed.count, set(mixed))) <= 3
    assert sorted(r.doc_id for r in seen["length_packing"].collect()) == sorted(mixed)

def test_stages_on_an_empty_table(spark):
    now = table(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = durable(stage(spark, now, ""))
    assert now.count() == 0

