"""Write modes, refresh and streams on small hand-computed inputs and as properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qa_analytics.operators import filters, refresh, writes
from qa_analytics.plans.analysis import analyse, ingest
from qa_analytics.schema import AUTHOR_SCHEMA, QUESTION_SCHEMA, STORED_QUESTION_SCHEMA
from qa_analytics.session import staging_path
from qa_analytics.sources import buckets, tables
from qa_analytics.streaming import ingest as streams, windows

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def question(qid, title="t", author="X", rep=1, tags=("a",), day=0):
    return (qid, title, "/q", "s", list(tags), author, rep, "/u", DAY + dt.timedelta(days=day), 1, 2, 3)


def batch(spark, *rows):
    frame = spark.createDataFrame(list(rows) or [], QUESTION_SCHEMA)
    seq = {i: r for i, r in enumerate(rows)}
    return spark.createDataFrame(
        [r + (i,) for i, r in seq.items()], "question_id long, title string, url string, summary string, tags array<string>, "
        "author_name string, author_reputation long, author_profile_url string, publication_date timestamp, "
        "view_count long, vote_count long, answer_count long, seq long") if rows else frame.withColumn("seq", F.lit(0).cast("long"))


def stored(spark, *rows):
    return filters.with_audit(spark.createDataFrame(list(rows) or [], QUESTION_SCHEMA), "2024-01-01")


def no_authors(spark):
    return spark.createDataFrame([], AUTHOR_SCHEMA)


def titles(df):
    return {r.question_id: r.title for r in df.collect()}


def test_upsert_last_one_wins_and_author_counts(spark):
    old = stored(spark, question(1, "old"))
    new = batch(spark, question(1, "v1", rep=5), question(1, "v2", rep=6), question(2, "v1", rep=7))
    run = ingest(old, no_authors(spark), new, "upsert", "2024-02-01")
    assert titles(run["questions"]) == {1: "v2", 2: "v1"}
    assert {r.stored_at.month for r in run["questions"].collect()} == {2}
    author = run["authors"].first()
    assert (author.author_name, author.reputation, author.question_count) == ("X", 7, 3)
    assert tuple(run["metrics"].first()) == (3, 3, 1, 2)
    again = ingest(run["questions"], run["authors"], new, "upsert", "2024-03-01")
    assert titles(again["questions"]) == {1: "v2", 2: "v1"}
    author = again["authors"].first()
    assert (author.question_count, author.first_seen.month, author.last_seen.month) == (6, 2, 3)
    assert tuple(again["metrics"].first()) == (3, 3, 0, 3)


def test_modes_on_known_and_new_ids(spark):
    old = stored(spark, question(1, "o1"), question(2, "o2"), question(3, "o3"))
    new = batch(spark, question(1, "n1"), question(4, "n4"), question(5, "n5"))
    touched = lambda mode: {r.question_id for r in writes.touched_ids(old, new, mode).collect()}
    assert touched("upsert") == {1, 4, 5} and touched("update") == {1} and touched("append-only") == {4, 5}
    update = ingest(old, no_authors(spark), new, "update", "2024-02-01")
    assert titles(update["questions"]) == {1: "n1", 2: "o2", 3: "o3"}
    assert tuple(update["metrics"].first()) == (3, 1, 0, 0)
    assert update["authors"].count() == 0
    append = ingest(old, no_authors(spark), new, "append-only", "2024-02-01")
    assert titles(append["questions"]) == {1: "o1", 2: "o2", 3: "o3", 4: "n4", 5: "n5"}
    assert tuple(append["metrics"].first()) == (3, 2, 1, 1)
    assert append["authors"].first().question_count == 2
    assert {r.state for r in filters.id_sets(old, new).collect()} == {"existing", "new"}


def test_empty_batch_and_empty_store(spark):
    none, old = batch(spark), stored(spark, question(1))
    for mode in writes.MODES:
        run = ingest(old, no_authors(spark), none, mode, "2024-02-01")
        assert run["questions"].count() == 1 and tuple(run["metrics"].first()) == (0, 0, 0, 0)
    fresh = ingest(old.limit(0), no_authors(spark), batch(spark, question(9)), "update", "2024-02-01")
    assert fresh["questions"].count() == 0 and fresh["touched_ids"].count() == 0


def test_anonymous_authors_make_no_rows(spark):
    new = batch(spark, question(1, author=""), question(2, author=None), question(3, author="Unknown"), question(4, author="Y"))
    people = writes.upsert_authors(no_authors(spark), new, "2024-02-01")
    assert [r.author_name for r in people.collect()] == ["Y"]


def test_update_only_authors_also_for_unknown_questions(spark):
    people = writes.upsert_authors(no_authors(spark), batch(spark, question(1, author="X")), "2024-01-05")
    after = writes.update_only_authors(people, batch(spark, question(99, author="X"), question(98, author="Z")), "2024-02-01")
    row = after.first()
    assert after.count() == 1 and (row.question_count, row.first_seen.month, row.last_seen.month) == (2, 1, 2)


def test_append_and_update_keys_make_up_upsert_keys(spark):
    old = stored(spark, *[question(i) for i in range(40)])
    new = batch(spark, *[question(i * 3 % 71) for i in range(60)])
    keys = lambda mode: {r.question_id for r in writes.touched_ids(old, new, mode).collect()}
    assert keys("update") | keys("append-only") == keys("upsert") and not keys("update") & keys("append-only")


def test_hot_question_and_author(spark):
    old = stored(spark, question(0, "o"))
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("question_id"),
        F.concat(F.lit("t"), "id").alias("title"), F.lit("").alias("url"), F.lit("").alias("summary"),
        F.array().cast("array<string>").alias("tags"), F.lit("X").alias("author_name"),
        F.col("id").alias("author_reputation"), F.lit("").alias("author_profile_url"),
        F.lit("2024-01-01").cast("timestamp").alias("publication_date"), F.lit(0).cast("long").alias("view_count"),
        F.lit(0).cast("long").alias("vote_count"), F.lit(0).cast("long").alias("answer_count"), F.col("id").alias("seq"))
    run = ingest(old, no_authors(spark), hot, "upsert", "2024-02-01")
    assert run["questions"].count() == 20_001
    assert run["questions"].where("question_id = 0").first().title == "t29997"
    assert run["authors"].first().question_count == 30_000
    assert tuple(run["metrics"].first()) == (30_000, 30_000, 1, 29_999)


def test_metrics_of_null_ids_and_nameless_authors(spark):
    old = stored(spark, question(1), question(None, author="Q"))
    people = no_authors(spark)
    new = batch(spark, question(1, author="A"), question(1, author=None), question(2, author="A"), question(2, author=" "),
                question(None, author="B"), question(3, author="B"))
    found = {m: tuple(writes.write_metrics(old, people, new, m).first()) for m in writes.MODES}
    assert found == {"upsert": (6, 6, 2, 2), "update": (6, 2, 0, 0), "append-only": (6, 4, 2, 1)}


def test_refresh_batches(spark):
    old = stored(spark, *[question(i) for i in range(250)])
    people = writes.upsert_authors(no_authors(spark), batch(spark, question(1, author="X")), "2024-01-05")
    found = list(range(60)) + list(range(200, 250))
    snapshot = batch(spark, *[question(i, author="X" if i < 10 else None) for i in found])
    batches = refresh.refresh_batches(old, people, snapshot)
    row = refresh.refresh_rollup(batches).first()
    assert (row.processed, row.updated, row.skipped, row.errors, row.success_rate) == (250, 110, 100, 0, 44.0)
    assert (row.authors_updated, row.batches_completed) == (10, 3)
    dry = refresh.refresh_rollup(refresh.refresh_batches(old, people, snapshot, dry_run=True)).first()
    assert (dry.updated, dry.authors_updated) == (110, 0)
    capped = refresh.refresh_rollup(refresh.refresh_batches(old, people, snapshot, max_questions=120)).first()
    assert (capped.processed, capped.updated, capped.skipped) == (120, 60, 20)
    failed = spark.createDataFrame([(5,), (7,)], "question_id long")
    broken = refresh.refresh_rollup(refresh.refresh_batches(old, people, snapshot, failed=failed), duration=10).first()
    assert (broken.errors, broken.updated, broken.authors_updated, broken.questions_per_second) == (100, 50, 0, 25.0)
    report = refresh.refresh_report(refresh.refresh_rollup(batches, duration=500)).first()
    assert (report.error_level, report.speed, report.many_skipped, report.ms_per_question) == ("none", "slow", False, 2000.0)
    high = refresh.refresh_report(refresh.refresh_rollup(
        refresh.refresh_batches(old, people, snapshot, failed=failed), duration=10)).first()
    assert (high.error_level, high.speed, high.error_rate) == ("high", "excellent", 40.0)


def test_bulk_lookup_is_complete(spark):
    ids = spark.range(250).select(F.col("id").alias("question_id"))
    found = refresh.bulk_lookup(ids, batch(spark, *[question(i) for i in range(100, 400)]), 100)
    assert found.count() == 150 and {r.batch_no for r in found.collect()} == {2, 3}


def test_analyse_whole_and_new_only(spark):
    rows = batch(spark, question(1, "how to code python", author="A"), question(2, "why is java slow", author="B", tags=("b", "c")))
    run = ingest(stored(spark).limit(0), no_authors(spark), rows, "upsert", "2024-01-02")
    every = analyse(run["questions"], run["authors"], "2024-01-02")
    assert every["status"].first().status == "analysed"
    assert every["activity_stats"].first().total_authors == 2
    assert {r.tag for r in every["top_tags"].collect()} == {"a", "b", "c"}
    one = analyse(run["questions"], run["authors"], "2024-01-02", spark.createDataFrame([(2,)], "question_id long"))
    assert {r.tag for r in one["most_common_tags"].collect()} == {"b", "c"}
    assert [r.author_name for r in one["top_authors"].collect()] == ["B"]
    none = analyse(run["questions"], run["authors"], "2024-01-02", spark.createDataFrame([], "question_id long"))
    assert set(none) == set(every) and none["status"].first().status == "skipped"
    assert none["top_tags"].count() == none["keywords"].count() == 0
    nothing = analyse(run["questions"].limit(0), run["authors"], "2024-01-02")
    assert set(nothing) == set(every)


def test_refresh_applies_itself(spark):
    old = stored(spark, *[question(i, "old") for i in range(1, 6)])
    people = writes.upsert_authors(no_authors(spark), batch(spark, question(1, author="X")), "2024-01-01")
    snapshot = batch(spark, *[question(i, "new", author="X", rep=70) for i in (2, 5, 9)])
    run = refresh.refreshed(old, people, snapshot, "2024-02-01", batch_size=2)
    assert {r.question_id: r.title for r in run["questions"].collect()} == {1: "old", 2: "new", 3: "old", 4: "old", 5: "new"}
    assert run["authors"].first().reputation == 70
    failed = spark.createDataFrame([(1,)], "question_id long")
    run = refresh.refreshed(old, people, snapshot, "2024-02-01", batch_size=2, failed=failed)
    assert {r.question_id for r in run["questions"].where("title = 'new'").collect()} == {5}
    dry = refresh.refreshed(old, people, snapshot, "2024-02-01", batch_size=2, dry_run=True)
    assert dry["questions"].where("title = 'new'").count() == 0 and dry["batches"].count() == 3


# ---- streams ----------------------------------------------------------------

def changed(spark, i):
    """The i-th arriving file: some repeated ids, some new ones, one hot author."""
    return batch(spark, *[
        question((i * 7 + j * 3) % 23, f"v{i}-{j}", author="hot" if j % 3 else f"a{j}", rep=i * 10 + j, day=i)
        for j in range(9)])


def arrived(spark, folder, count):
    files = [changed(spark, i) for i in range(count)]
    for i, frame in enumerate(files):
        frame.coalesce(1).write.parquet(f"{folder}/f{i}")
    return files


def by_key(df, key):
    return {r[key]: tuple(sorted(r.asDict().items(), key=lambda x: x[0])) for r in df.collect()}


def stream(spark, folder):
    schema = changed(spark, 0).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("mode", ["upsert", "append-only"])
def test_stream_equals_the_batches_one_after_another(spark, mode):
    base = staging_path(spark, "test")
    seed = stored(spark, *[question(i, "seed") for i in range(5)])
    people = writes.upsert_authors(no_authors(spark), seed.withColumn("seq", F.col("question_id")), "2024-01-01")
    streams.seed_store(spark, f"{base}/store", seed, people)
    files = arrived(spark, f"{base}/in", 4)
    run = streams.stream_upsert if mode == "upsert" else streams.stream_append
    run(stream(spark, f"{base}/in"), f"{base}/store", f"{base}/progress", "2024-02-01")
    questions, authors = seed, people
    for frame in files:
        result = ingest(questions, authors, frame, mode, "2024-02-01")
        questions, authors = result["questions"], result["authors"]
    expected = by_key(questions, "question_id"), by_key(authors, "author_name")
    current = lambda: (by_key(streams.current_questions(spark, f"{base}/store"), "question_id"),
                       by_key(streams.current_authors(spark, f"{base}/store"), "author_name"))
    assert current() == expected
    streams.compact(spark, f"{base}/store")
    assert current() == expected
    changed(spark, 9).coalesce(1).write.parquet(f"{base}/in/f9")
    run(stream(spark, f"{base}/in"), f"{base}/store", f"{base}/progress", "2024-02-01")
    result = ingest(questions, authors, changed(spark, 9), mode, "2024-02-01")
    assert current() == (by_key(result["questions"], "question_id"), by_key(result["authors"], "author_name"))


def test_a_retried_batch_counts_once(spark):
    base = staging_path(spark, "test")
    frame = changed(spark, 1)
    for _ in range(2):
        fresh = filters.with_audit(writes.latest_per_key(frame).select(*QUESTION_SCHEMA.fieldNames()), "2024-02-01")
        streams._write_changes(f"{base}/store", 0, fresh, writes.author_updates(frame), "2024-02-01")
    total = streams.current_authors(spark, f"{base}/store").agg(F.sum("question_count")).first()[0]
    assert total == 9


def test_stream_into_an_empty_store(spark):
    base = staging_path(spark, "test")
    files = arrived(spark, f"{base}/in", 2)
    streams.stream_append(stream(spark, f"{base}/in"), f"{base}/store", f"{base}/progress", "2024-02-01")
    ids = {r.question_id for f in files for r in f.collect()}
    assert {r.question_id for r in streams.current_questions(spark, f"{base}/store").collect()} == ids


def test_stream_new_only_status(spark):
    base = staging_path(spark, "test")
    arrived(spark, f"{base}/in", 1)
    changed(spark, 0).coalesce(1).write.parquet(f"{base}/in/again")
    streams.stream_new_only(stream(spark, f"{base}/in"), f"{base}/store", f"{base}/progress", "2024-02-01", f"{base}/results")
    status = {r.batch_id: (r.status, r.questions) for r in streams.read_results(spark, f"{base}/results", "status").collect()}
    assert status == {0: ("analysed", 9), 1: ("skipped", 0)}
    tags = streams.read_results(spark, f"{base}/results", "tags").collect()
    assert [(r.tag, r["count"]) for r in tags] == [("a", 9)]


def test_fifty_triggers_keep_few_folders(spark):
    base = staging_path(spark, "test")
    streams.seed_store(spark, f"{base}/store", buckets=2)
    questions, authors, most = stored(spark, question(0)).limit(0), {}, 0
    expected = {}
    for i in range(50):
        rows = [question((i * 3 + j) % 11, f"v{i}", author=f"a{j}", rep=i) for j in range(3)]
        frame = batch(spark, *rows)
        fresh = filters.with_audit(writes.latest_per_key(frame).select(*QUESTION_SCHEMA.fieldNames()), "2024-02-01")
        streams._write_changes(f"{base}/store", i, fresh, writes.author_updates(frame), "2024-02-01", 2)
        streams._fold_when_due(spark, f"{base}/store", 5)
        most = max(most, len(streams.waiting_batches(spark, f"{base}/store")))
        expected |= {r[0]: f"v{i}" for r in rows}
    assert most < 5
    assert titles(streams.current_questions(spark, f"{base}/store")) == expected
    counts = {r.author_name: (r.question_count, r.reputation) for r in streams.current_authors(spark, f"{base}/store").collect()}
    assert counts == {f"a{j}": (50, 49) for j in range(3)}


def test_a_batch_retried_after_its_fold_changes_nothing(spark):
    base = staging_path(spark, "test")
    seed = stored(spark, question(0, "seed"))
    people = writes.upsert_authors(no_authors(spark), seed.withColumn("seq", F.col("question_id")), "2024-01-01")
    streams.seed_store(spark, f"{base}/store", seed, people, buckets=3)
    frame = changed(spark, 1)
    state = lambda: (by_key(streams.current_questions(spark, f"{base}/store"), "question_id"),
                     by_key(streams.current_authors(spark, f"{base}/store"), "author_name"))
    streams._append_batch(frame, 0, f"{base}/store", "2024-02-01")
    once = state()
    for _ in range(2):
        streams.compact(spark, f"{base}/store")
        assert state() == once and streams.waiting_batches(spark, f"{base}/store") == []
        streams._append_batch(frame, 0, f"{base}/store", "2024-02-01")
        assert state() == once


def test_rows_delivered_again_and_late_rows(spark):
    base = staging_path(spark, "test")
    files = arrived(spark, f"{base}/in", 2)
    files[0].coalesce(1).write.parquet(f"{base}/in/again")
    # A question much older than all others, and a known id with a new version.
    late = batch(spark, question(900, "late", author="old", day=-3000), question(7, "new version", author="old"))
    late.coalesce(1).write.parquet(f"{base}/in/late")
    streams.stream_append(stream(spark, f"{base}/in"), f"{base}/store", f"{base}/progress", "2024-02-01", fold_after=2)
    questions, authors = stored(spark, question(0)).limit(0), no_authors(spark)
    for frame in (*files, late):
        result = ingest(questions, authors, frame, "append-only", "2024-02-01")
        questions, authors = result["questions"], result["authors"]
    assert by_key(streams.current_questions(spark, f"{base}/store"), "question_id") == by_key(questions, "question_id")
    assert by_key(streams.current_authors(spark, f"{base}/store"), "author_name") == by_key(authors, "author_name")


def test_stream_windows_equal_the_batch_counts(spark):
    base = staging_path(spark, "test")
    files = arrived(spark, f"{base}/in", 4)
    windows.stream_tag_windows(stream(spark, f"{base}/in"), f"{base}/out", f"{base}/progress", lateness="30 days")
    everything = filters.concat_batches(files)
    expected = {(r.window_start, r.tag): r["count"] for r in windows.windowed_tag_counts(everything).collect()}
    got = {(r.window_start, r.tag): r["count"] for r in windows.current_tag_windows(spark, f"{base}/out").collect()}
    assert got == expected and len(got) == 4


# ---- tables -----------------------------------------------------------------

def files_by_bucket(spark, path):
    rows = spark.read.parquet(path).select("bucket", F.input_file_name().alias("file")).distinct().collect()
    found = {}
    for r in rows:
        found.setdefault(r.bucket, set()).add(r.file)
    return found


@pytest.mark.parametrize("mode", writes.MODES)
def test_bucketed_writes_equal_snapshots_and_touch_only_their_buckets(spark, mode):
    path = staging_path(spark, "test") + "/questions"
    old = stored(spark, *[question(i, "old") for i in range(200)])
    buckets.create_store(old, path, 16)
    new = batch(spark, question(3, "v1"), question(3, "v2"), question(150, "v1"), question(1000, "new"))
    before = files_by_bucket(spark, path)
    run = {"upsert": buckets.upsert_into, "update": buckets.update_in, "append-only": buckets.append_to}[mode]
    expected = by_key(ingest(old, no_authors(spark), new, mode, "2024-02-01")["questions"], "question_id")
    for _ in range(2):
        run(spark, path, new, "2024-02-01", 16)
        assert by_key(buckets.stored_questions(spark, path), "question_id") == expected
    after = files_by_bucket(spark, path)
    ids = {"upsert": [3, 150, 1000], "update": [3, 150], "append-only": [1000]}[mode]
    rows = spark.createDataFrame([(i,) for i in ids], "question_id long")
    touched = set(buckets.touched_buckets(rows, "question_id", 16))
    assert {b for b in after if after[b] != before.get(b)} == touched
    if mode == "append-only":
        assert all(before[b] <= after[b] for b in before)


def test_bucketed_writes_of_nothing_and_null_ids(spark):
    path = staging_path(spark, "test") + "/questions"
    buckets.create_store(stored(spark).limit(0), path, 4)
    for run in (buckets.upsert_into, buckets.update_in, buckets.append_to):
        run(spark, path, batch(spark), "2024-02-01", 4)
        assert buckets.stored_questions(spark, path).count() == 0
    buckets.upsert_into(spark, path, batch(spark, question(None, "a"), question(1, "b")), "2024-02-01", 4)
    assert titles(buckets.stored_questions(spark, path)) == {None: "a", 1: "b"}


def test_rows_without_arrival_order_come_before_any(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, "b", 3), (2, "c", None)], "question_id long, title string, seq long")
    assert {r.question_id: r.title for r in writes.latest_per_key(rows).collect()} == {1: "b", 2: "c"}


def test_snapshots_and_exports(spark):
    base = staging_path(spark, "test")
    questions = stored(spark, question(1), question(2, day=3))
    path = tables.write_snapshot(questions, f"{base}/questions", 1)
    assert tables.read_questions(spark, path).schema == STORED_QUESTION_SCHEMA
    with pytest.raises(Exception):
        tables.write_snapshot(questions, f"{base}/questions", 1)
    counts = questions.groupBy("author_name").count()
    rows = tables.analysis_rows({"authors": counts}, "comprehensive_trend_analysis", "2024-02-01", 2, 1.5)
    row = rows.first()
    assert (row.result, row.metadata.total_questions_analyzed) == ('{"author_name":"X","count":2}', 2)
    tables.append_analysis(rows, f"{base}/analysis")
    tables.append_analysis(rows, f"{base}/analysis")
    assert spark.read.parquet(f"{base}/analysis").count() == 2
    tables.save_results({"authors": counts}, base, "20240201_000000")
    assert spark.read.json(f"{base}/analysis_results_20240201_000000/authors").first()["count"] == 2
    people = writes.upsert_authors(no_authors(spark), batch(spark, question(1)), "2024-02-01")
    export = tables.export_tables(questions, people, counts, "2024-02-01", max_questions=1)
    tables.export_json(export, f"{base}/export")
    assert [r.question_id for r in spark.read.json(f"{base}/export/questions").collect()] == [2]
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert sorted(r.result for r in tables.result_rows(odd, "odd").collect()) == ['{"v":1.0}', "{}"]
    assert tables.read_authors(spark, tables.write_snapshot(people, f"{base}/authors", 1)).count() == 1
