"""Question views over the test tables."""

from pyspark.sql import DataFrame, functions as F

from ..functions.text import once
from ..operators.filters import with_audit
from ..operators.writes import upsert_authors
from ..schema import AUTHOR_SCHEMA

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-02-05"
STORED_AT = "2024-01-21"
WRITTEN_AT = "2024-02-01"
EXISTING_BEFORE = "2024-01-21"
INCOMING_FROM = "2024-01-11"


def table(spark, sf_dir, name) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key) -> DataFrame:
    """Rows dealt out by a key.

    Only for these views: a test table is one file with one row group, which a
    scan cannot split. Operators never do this to a text they are given.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def events_as_questions(events: DataFrame) -> DataFrame:
    """Each event as a question; also works on a stream of events."""
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.col("event_id").alias("question_id"),
        F.concat_ws(" ", "event_type", F.lit("event of user"), "user_id").alias("title"),
        F.concat(F.lit("/questions/"), "event_id", F.lit("/"), "event_type").alias("url"),
        F.col("props").alias("summary"),
        F.array("event_type", F.concat(F.lit("k"), k)).alias("tags"),
        F.concat(F.lit("user"), "user_id").alias("author_name"),
        F.floor(F.col("value") * 10).alias("author_reputation"),
        F.concat(F.lit("/users/"), "user_id").alias("author_profile_url"),
        F.col("ts").cast("timestamp").alias("publication_date"),
        F.floor("value").alias("view_count"),
        (k - 50).alias("vote_count"),
        (k % 5).alias("answer_count"),
    )


def q_events(spark, sf_dir) -> DataFrame:
    return events_as_questions(table(spark, sf_dir, "events"))


def q_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    price = F.floor("o_totalprice")
    return orders.select(
        F.col("o_orderkey").alias("question_id"),
        F.concat(F.lit("Order "), "o_orderkey").alias("title"),
        F.concat(F.lit("/questions/"), "o_orderkey").alias("url"),
        F.lit("").alias("summary"),
        F.array(
            F.lower("o_orderpriority"), "o_orderstatus",
            F.concat(F.lit("price-"), F.floor(F.col("o_totalprice") / 10000)),
        ).alias("tags"),
        F.concat(F.lit("customer"), "o_custkey").alias("author_name"),
        F.lit(0).cast("long").alias("author_reputation"),
        F.concat(F.lit("/users/"), "o_custkey").alias("author_profile_url"),
        F.col("o_orderdate").cast("timestamp").alias("publication_date"),
        price.alias("view_count"),
        (price % 100 - 50).alias("vote_count"),
        (price % 4).alias("answer_count"),
    )


def q_docs(spark, sf_dir) -> DataFrame:
    """Documents as questions: the first line is the title, the whole rest the summary."""
    title = F.substring_index("text", "\n", 1)
    return dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("question_id"), title.alias("title"),
        F.substr("text", F.length(title) + 2).alias("summary"))


def existing(spark, sf_dir) -> DataFrame:
    """The stored table: events before a day."""
    return with_audit(q_events(spark, sf_dir).where(F.col("publication_date") < F.lit(EXISTING_BEFORE).cast("timestamp")), STORED_AT)


def as_incoming(questions: DataFrame) -> DataFrame:
    """A later crawl of the recent questions."""
    return as_versions(questions.where(F.col("publication_date") >= F.lit(INCOMING_FROM).cast("timestamp")))


def as_versions(questions: DataFrame) -> DataFrame:
    """Newer votes, and every purchase comes twice."""
    versions = F.when(
        F.get("tags", F.lit(0)) == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = questions.withColumn("_version", F.explode(versions))
    return rows.withColumns({
        "vote_count": F.col("vote_count") + F.when(F.col("_version") == 0, 1).otherwise(100),
        "seq": F.col("question_id") * 2 + F.col("_version"),
    }).drop("_version")


def incoming(spark, sf_dir) -> DataFrame:
    return as_incoming(q_events(spark, sf_dir))


def authors0(spark, sf_dir) -> DataFrame:
    """Authors of the stored table."""
    empty = spark.createDataFrame([], AUTHOR_SCHEMA)
    return upsert_authors(empty, existing(spark, sf_dir).withColumn("seq", F.col("question_id")), STORED_AT)


def all_stored(spark, sf_dir) -> DataFrame:
    """Every event as a stored question."""
    return with_audit(q_events(spark, sf_dir), STORED_AT)


def all_authors(spark, sf_dir) -> DataFrame:
    """Authors of every event."""
    empty = spark.createDataFrame([], AUTHOR_SCHEMA)
    return upsert_authors(empty, all_stored(spark, sf_dir).withColumn("seq", F.col("question_id")), STORED_AT)


def all_versions(spark, sf_dir) -> DataFrame:
    """Every event as a crawled batch row; every purchase comes twice."""
    return as_versions(q_events(spark, sf_dir))


def payload_pages(spark, sf_dir, items=100) -> DataFrame:
    """Events as JSON response texts of `items` questions each."""
    q = q_events(spark, sf_dir)
    item = F.struct(
        "question_id", "title", F.col("url").alias("link"),
        F.concat(F.lit("<p>"), "title", F.lit(" &lt;b&gt; &amp;lt; <code>"), F.repeat(F.col("summary"), F.lit(50)),
                 F.lit("</code></p>")).alias("body"),
        "tags",
        F.struct(F.col("author_name").alias("display_name"), F.col("author_reputation").alias("reputation"),
                 F.col("author_profile_url").alias("link")).alias("owner"),
        F.unix_seconds("publication_date").alias("creation_date"),
        "view_count", F.col("vote_count").alias("score"), "answer_count",
    )
    return q.groupBy(F.floor(F.col("question_id") / items).alias("page")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload"))


def listing_pages(spark, sf_dir, cards=50) -> DataFrame:
    """Events as HTML listing pages of `cards` question cards each.

    Events move to their page before the cards are written, which are many times larger.
    """
    q = events_as_questions(table(spark, sf_dir, "events").repartition(F.floor(F.col("event_id") / cards)))
    rep = F.col("author_reputation")
    rep_text = F.when(rep >= 1000, F.concat((rep / 1000.0).cast("string"), F.lit("k"))).otherwise(rep.cast("string"))
    links = F.array_join(
        F.transform("tags", lambda t: F.concat(F.lit('<a class="post-tag">'), t, F.lit("</a>"))), " ")

    def stat(title, column):
        return F.concat(
            F.lit(f'<div class="s-post-summary--stats-item" title="{title}">'
                  '<span class="s-post-summary--stats-item-number">'), F.col(column), F.lit("</span></div>"))

    card = F.concat(
        F.lit('<div class="s-post-summary js-post-summary"><div class="s-post-summary--stats">'),
        stat("Score of the post", "vote_count"), stat("answers", "answer_count"), stat("views", "view_count"),
        F.lit('</div><h3 class="s-post-summary--content-title"><a href="'), "url", F.lit('"> '), "title",
        F.lit(' </a></h3><div class="s-post-summary--content-excerpt">'), "summary",
        F.lit('</div><div class="s-post-summary--meta-tags">'), links,
        F.lit('</div><div class="s-user-card"><div class="s-user-card--link"><a href="'), "author_profile_url",
        F.lit('">'), "author_name", F.lit('</a></div><span title="reputation score">'), rep_text,
        F.lit('</span></div><span class="relativetime" title="'),
        F.date_format("publication_date", "yyyy-MM-dd HH:mm:ss'Z'"), F.lit('">asked</span></div>'),
    )
    body = F.array_join(F.array_sort(F.collect_list(card)), "")
    return q.groupBy(F.floor(F.col("question_id") / cards).alias("page_id")).agg(
        F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def log_lines(spark, sf_dir) -> DataFrame:
    """Events as lines of a test log, with its total duration line."""
    events = table(spark, sf_dir, "events")
    name = F.concat_ws("_", F.lit("test"), "event_type", "event_id")
    seconds = F.format_string(" (%.2fs)", "value")
    kind = F.col("event_type")
    line = (
        F.when(kind.isin("view", "click"), F.concat(F.lit("✅ RÉUSSI: "), name, seconds))
        .when(kind == "purchase", F.concat(F.lit("❌ ÉCHEC: "), name, seconds))
        .when(kind == "error", F.concat(F.lit("🚫 ERREUR: "), name))
        .otherwise(F.concat(F.lit("⏭️  IGNORÉ: "), name))
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    lines = events.select(once(F.concat(stamp, F.lit(" - INFO - "), line)).alias("value"))
    total = events.agg(F.format_string("Durée totale: %.2f secondes", F.sum("value")).alias("value"))
    return lines.unionByName(total)
