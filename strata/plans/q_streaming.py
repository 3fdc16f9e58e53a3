"""Catalogue entries: the streaming flow, each run with ``availableNow`` over
the events table and read back from its sink.  The oracles are the batch
equivalents, restricted by the same watermark rule where the stream only
emits closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import ts_text
from strata.operators import quality
from strata.sinks.writers import read_current
from strata.streaming import layers as st
from strata.plans.queries import register
from strata.session import scratch_path
from strata.sources.tables import table

TS = "'%Y-%m-%d %H:%M:%S'"
DELAY = "1 hour"


def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return st.read_files(spark, sf_dir, schema, glob="events.parquet")


def _parts(spark, sf_dir):
    return st.state_partitions_for(spark, sf_dir, "events.parquet")


@register("stream_bronze", """
SELECT *, 'events' AS _source_file FROM events""")
def stream_bronze(spark, sf_dir):
    """T1 + S8: arriving files -> provenance stamps -> appended bronze Parquet."""
    out = st.run_available_now(st.bronze(_events_stream(spark, sf_dir)), name="stream-bronze")
    return spark.read.parquet(f"{out}/data").drop("_ingestion_timestamp")


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """T2 + D7: state-bounded dedup of (user, event type) within the watermark."""
    s = st.event_time(_events_stream(spark, sf_dir), "ts")
    out = st.run_available_now(st.dedup(s, ["user_id", "event_type"], "ts", "30 days"), name="stream-dedup",
                               state_partitions=_parts(spark, sf_dir))
    return spark.read.parquet(f"{out}/data").select("user_id", "event_type")


_CLOSED = f"(SELECT max(ts) FROM events) - INTERVAL {DELAY}"


@register("stream_windows", f"""
SELECT strftime(b, {TS}) AS window_start, strftime(b + INTERVAL 1 HOUR, {TS}) AS window_end, event_type,
       count(*) AS events
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS b, event_type FROM events)
GROUP BY b, event_type
HAVING b + INTERVAL 1 HOUR <= {_CLOSED}""")
def stream_windows(spark, sf_dir):
    """Hourly counts per event type, written once each window closes."""
    s = st.event_time(_events_stream(spark, sf_dir), "ts")
    out = st.run_available_now(st.window_counts(s, "ts", "1 hour", ["event_type"], DELAY),
                               name="stream-windows", state_partitions=_parts(spark, sf_dir))
    r = spark.read.parquet(f"{out}/data")
    return r.select(ts_text("window_start").alias("window_start"), ts_text("window_end").alias("window_end"),
                    "event_type", "events")


@register("stream_sessions", f"""
WITH s AS (SELECT user_id, ts,
                  CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS new
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, strftime(min(ts), {TS}) AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, {TS}) AS session_end, count(*) AS events
FROM g GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""")
def stream_sessions(spark, sf_dir):
    """T4: per-user sessions (30-minute gap), written once closed."""
    s = st.event_time(_events_stream(spark, sf_dir), "ts")
    out = st.run_available_now(st.sessions(s, "ts", "30 minutes", ["user_id"], DELAY), name="stream-sessions",
                               state_partitions=_parts(spark, sf_dir), conf=st.MERGE_SESSIONS_FIRST)
    r = spark.read.parquet(f"{out}/data")
    return r.select("user_id", ts_text("session_start").alias("session_start"),
                    ts_text("session_end").alias("session_end"), "events")


@register("stream_merge", f"""
SELECT user_id, event_id, event_type, strftime(ts, {TS}) AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_merge(spark, sf_dir):
    """T5: latest event per user merged into silver by ``foreachBatch``."""
    s = _events_stream(spark, sf_dir).select("user_id", "event_id", "event_type", "ts")
    base = scratch_path(spark, "stream-merge")
    st.run_available_now(s, name="stream-merge", sink=st.merge_into(f"{base}/silver", "user_id",
                                                                      ["ts", "event_id"]),
                         path=base)
    cur = read_current(spark, f"{base}/silver")
    return cur.select("user_id", "event_id", "event_type", ts_text("ts").alias("ts"))


def _checks(batch):
    return quality.run_checks(batch.withColumn("user", F.col("user_id").cast("string")), "bronze.events", [
        quality.accepted_values("event_type", ("click", "view", "purchase", "signup")), quality.completeness("user")])


@register("stream_quality", """
SELECT 'event_type_accepted_values' AS check_name,
       count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase', 'signup')) AS passed_count,
       count(*) FILTER (WHERE NOT coalesce(event_type IN ('click', 'view', 'purchase', 'signup'), false))
         AS failed_count
FROM events
UNION ALL
SELECT 'user_completeness', count(user_id), count(*) - count(user_id) FROM events""")
def stream_quality(spark, sf_dir):
    """The quality checks of every micro-batch appended to the log;
    summed over batches they equal the batch checks."""
    base = scratch_path(spark, "stream-quality")
    st.run_available_now(_events_stream(spark, sf_dir), name="stream-quality",
                         sink=st.quality_into(f"{base}/log", _checks), path=base)
    log = spark.read.parquet(f"{base}/log")
    return log.groupBy("check_name").agg(F.sum("passed_count").alias("passed_count"),
                                         F.sum("failed_count").alias("failed_count"))
