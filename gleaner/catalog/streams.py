"""Streams replayed from the tables' files until nothing is left, then read back."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from gleaner.catalog.base import art, entries, query, store, table
from gleaner.catalog.joins import RULE_SCORE, RULE_SQL, SCORING, rule_table
from gleaner.catalog.time_windows import ZONES
from gleaner.catalog.windows_and_sorts import BEST
from gleaner.functions import dates as D
from gleaner.functions import urls as U
from gleaner.session import shared_dir
from gleaner.streaming import flows

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGE = "page_id bigint, url string, html string"


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def _events(spark, sf_dir):
    """Events as a stream, with a time Spark can watermark."""
    rows = flows.ingest(spark, f"{sf_dir}/events.parquet", EVENT)
    return rows.withColumn("at", F.col("ts").cast("timestamp"))


def _finish(running):
    running.awaitTermination()
    if running.exception():
        raise running.exception()


@query("stream_ingest", "SELECT event_id, event_type, ts FROM events")
def stream_ingest(spark, sf_dir):
    folder = _folder(spark, "ingest")
    _finish(flows.run_to_files(_events(spark, sf_dir).select("event_id", "event_type", "ts"), folder))
    return flows.read_output(spark, f"{folder}/out", "event_id bigint, event_type string, ts timestamp_ntz")


@query("stream_dedupe", "SELECT DISTINCT user_id || '|' || json_extract_string(props, '$.k') AS key FROM events")
def stream_dedupe(spark, sf_dir):
    folder = _folder(spark, "dedupe")
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"))
    rows = _events(spark, sf_dir).select("at", key.alias("key"))
    _finish(flows.run_to_files(flows.first_sightings(rows, "key", "at", lookback=None).select("key"), folder))
    return flows.read_output(spark, f"{folder}/out", "key string")


GATE_AT = "SELECT max(ts) AS t FROM events"


def gate_rows(events):
    return events.select(
        "event_id", F.col("ts").alias("published_utc"), F.lit(None).cast("string").alias("parsed_date"),
        F.lit("rolling_24h").alias("target_date_mode"), F.lit(24).alias("lookback_hours"), F.lit(ZONES[0]).alias("date_timezone"),
    )


def gate_time(spark, sf_dir):
    """The run's time, one value."""
    return F.lit(table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]).cast("timestamp_ntz")


@query(
    "stream_window_gate",
    f"""WITH r AS ({GATE_AT}) SELECT event_id, CASE WHEN ts >= t - INTERVAL 24 HOUR AND ts < t THEN 'accepted' ELSE 'out_of_window' END AS decision FROM events, r""",
)
def stream_window_gate(spark, sf_dir):
    folder = _folder(spark, "gate")
    rows, as_of = gate_rows(_events(spark, sf_dir)), gate_time(spark, sf_dir)
    _finish(flows.run_batches(rows, flows.gate_sink(f"{folder}/out", as_of), folder))
    return spark.read.parquet(f"{folder}/out").select("event_id", "decision")


@query(
    "stream_first_keys",
    """WITH e AS (SELECT event_id, ts, event_id % 3 AS part, user_id || '|' || json_extract_string(props, '$.k') AS key FROM events),
    clock AS (SELECT p.part, (SELECT max(ts) FROM e WHERE e.part < p.part) AS newest FROM (SELECT DISTINCT part FROM e) p)
    SELECT 'first' AS kind, key, event_id FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY part, event_id) = 1
    UNION ALL SELECT 'late', key, event_id FROM e JOIN clock USING (part) WHERE ts < newest - INTERVAL 20 DAY""",
)
def stream_first_keys(spark, sf_dir):
    """Three batches in no order of time: the first row of each key over all of them, and the rows that came late."""
    folder = _folder(spark, "keys")
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"))
    rows = table(spark, sf_dir, "events").select("event_id", "ts", key.alias("key"))
    sink = flows.seen_sink(folder, "key", "ts", "event_id", lateness="20 days", every=1)
    for part in range(3):
        sink(rows.where(F.col("event_id") % 3 == part), part)
    found = [spark.read.parquet(f"{folder}/{kind}").select(F.lit(kind).alias("kind"), "key", "event_id") for kind in ("first", "late")]
    return found[0].unionByName(found[1])


@query(
    "stream_window_late",
    f"""WITH r AS ({GATE_AT}), e AS (SELECT *, event_id % 2 AS part FROM events), c AS (SELECT max(ts) AS newest FROM e WHERE part = 0)
    SELECT event_id, CASE WHEN part = 1 AND ts < newest - INTERVAL 10 DAY THEN 'late' WHEN ts >= t - INTERVAL 24 HOUR AND ts < t THEN 'accepted' ELSE 'out_of_window' END AS decision FROM e, r, c""",
)
def stream_window_late(spark, sf_dir):
    """Two batches through the window gate: rows behind the clock come out beside the decisions."""
    folder = _folder(spark, "gate-late")
    rows = gate_rows(table(spark, sf_dir, "events"))
    sink = flows.gate_sink(f"{folder}/out", gate_time(spark, sf_dir), lateness="10 days", late_folder=f"{folder}/late")
    for part in range(2):
        sink(rows.where(F.col("event_id") % 2 == part), part)
    late = spark.read.parquet(f"{folder}/late/rows").select("event_id", F.lit("late").alias("decision"))
    return spark.read.parquet(f"{folder}/out").select("event_id", "decision").unionByName(late)


@query("stream_counts", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY date_trunc('day', ts), event_type")
def stream_counts(spark, sf_dir):
    """Counts so far of every day, open days too: each batch passes on the days it changed."""
    folder = _folder(spark, "counts")
    counted = flows.daily_counts(_events(spark, sf_dir), "at", ["event_type"], lateness=None)
    _finish(flows.run_batches(counted, flows.latest_sink(f"{folder}/out"), folder, mode="update"))
    out = flows.read_latest(spark, f"{folder}/out", ["start", "event_type"])
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(
    "stream_upsert",
    """WITH {store}, last AS (SELECT url, page_id FROM store QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord DESC) = 1),
    m AS (SELECT p.page_id AS n, p.url, l.page_id AS pid FROM pages p LEFT JOIN last l ON l.url = p.url),
    upd AS (SELECT pid, max(n) AS n FROM m WHERE pid IS NOT NULL GROUP BY pid)
    SELECT s.page_id, s.url, coalesce('Title ' || upd.n, s.title) AS title FROM store s LEFT JOIN upd ON upd.pid = s.page_id
    UNION ALL SELECT 'new-' || left(sha256(n || '|' || url), 16), url, 'Title ' || n FROM m WHERE pid IS NULL""",
)
def stream_upsert(spark, sf_dir):
    """The store after the last batch."""
    folder = _folder(spark, "upsert")
    pages = flows.ingest(spark, f"{sf_dir}/pages.parquet", PAGE)
    rows = pages.select(
        F.col("page_id").alias("n"), "url", F.lit("").alias("page_id"), F.lit("").alias("error"),
        F.concat(F.lit("Title "), F.col("page_id").cast("string")).alias("title"),
    )
    saved = store(spark, sf_dir).select("page_id", "url", "title", "ord")
    _finish(flows.run_batches(rows, flows.upsert_sink(f"{folder}/store", saved, "n", ["title"]), folder))
    return flows.open_store(f"{folder}/store", saved, ["title"]).rows().select("page_id", "url", "title")


@query(
    "stream_upsert_dated",
    """WITH {store}, inc AS (SELECT ord AS n, url, issue_date, (ord * 7) % 3 AS part FROM store WHERE ord % 5 <> 0),
    last AS (SELECT url, left(issue_date, 6) AS month, max_by(page_id, ord) AS pid FROM store GROUP BY ALL),
    hit AS (SELECT inc.n, inc.part, l.pid FROM inc JOIN last l ON l.url = inc.url AND l.month = left(inc.issue_date, 6)),
    upd AS (SELECT pid, arg_max(n, part * 10000000000 + n) AS n FROM hit GROUP BY pid)
    SELECT s.page_id, s.issue_date, coalesce('Title ' || upd.n, s.title) AS title FROM store s LEFT JOIN upd ON upd.pid = s.page_id""",
)
def stream_upsert_dated(spark, sf_dir):
    """Three batches against a store filed by issue date, with a new base after every second one."""
    folder = _folder(spark, "dated")
    saved = store(spark, sf_dir).select("page_id", "url", "title", "issue_date", "ord")
    rows = saved.where(F.col("ord") % 5 != 0).select(
        F.col("ord").alias("n"), "url", F.lit("").alias("page_id"), F.lit("").alias("error"), "issue_date",
        F.concat(F.lit("Title "), F.col("ord").cast("string")).alias("title"),
    )
    sink = flows.upsert_sink(folder, saved, "n", ["title"], date="issue_date", every=2)
    for part in range(3):
        sink(rows.where((F.col("n") * 7) % 3 == part), part)
    return flows.open_store(folder, saved, ["title"], "issue_date").rows().select("page_id", "issue_date", "title")


@query(
    "stream_score",
    f"WITH {{art}}, {RULE_SQL}, {SCORING}, {RULE_SCORE} SELECT article_id, score, priority FROM rule_scored",
)
def stream_score(spark, sf_dir):
    folder = _folder(spark, "score")
    rows = art_stream(spark, sf_dir).select(
        "article_id", "ord", "url", F.col("title").alias("source_title"), F.col("title").alias("page_title"), F.col("body").alias("text")
    )
    _finish(flows.run_batches(rows, flows.score_sink(f"{folder}/out", rule_table, "article_id"), folder))
    out = spark.read.parquet(f"{folder}/out")
    return out.select("article_id", F.col("importance_score").alias("score"), "priority")


def art_stream(spark, sf_dir):
    from gleaner.catalog.base import articles_of

    return articles_of(flows.ingest(spark, f"{sf_dir}/documents.parquet", DOCUMENT))


@query(
    "stream_first_seen",
    f"WITH {{art}}, {BEST} SELECT aid AS article_id, ord, source, first_seen FROM best",
)
def stream_first_seen(spark, sf_dir):
    """Best version of each article; versions arrive over half a year, by place."""
    folder = _folder(spark, "versions")
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("ord") % 180 * 86400)
    rows = art_stream(spark, sf_dir).select(
        "ord", "url", "body", F.when(F.col("ord") % 4 == 0, F.lit("saved")).otherwise(F.lit("new")).alias("source"), at.alias("at")
    )
    best = flows.best_versions(rows, "url", "body", "source", "at", "saved", timedelta(days=365), lateness="365 days")
    _finish(flows.run_batches(best, flows.latest_sink(f"{folder}/out"), folder, mode="update", timers=True))
    return flows.read_latest(spark, f"{folder}/out", ["article_id"]).select("article_id", "ord", "source", "first_seen")
