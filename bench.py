"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores; BENCH_QUERIES (comma separated, or `all`) chooses queries.
Every query is planned and run to the end three times; `queries` holds the
better of the last two (warm) times, `cold` the first.
"""

import json
import os
import time

from qa_analytics.plans.catalog import QUERIES
from qa_analytics.session import get_session

HEADLINE = """
tag_statistics tag_summary tag_trends trending_tags hourly_patterns activity_peaks report_counters store_stats
batch_distincts activity_stats authors_of_questions questions_page questions_by_ids questions_any_tag
cleaned_text keywords_title keywords_summary report_keywords sentiment_summary content_quality length_stats
upsert_questions update_only_questions append_only_questions upsert_authors write_metrics refresh_rollup
payload_to_questions listing_extract page_links schema_profile log_rollup stream_append stream_upsert stream_tag_windows
""".split()


def run(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = get_session(
        "qa-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        cold[name] = run(spark, name, sf_dir)
        warm[name] = min(run(spark, name, sf_dir) for _ in range(2))
    print(json.dumps({
        "metric": "total_warm_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
