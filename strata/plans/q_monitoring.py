"""Catalogue entries: monitoring rules and metrics tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import epoch_seconds, ts_text
from strata.operators import gold, lineage, monitoring as mon, quality
from strata.plans import fixtures as fx
from strata.plans.queries import AS_OF, f1_layers, register
from strata.sources.files import list_files
from strata.sources.tables import table

W = fx.with_ctes
TS = "'%Y-%m-%d %H:%M:%S'"


def _islands_sql(src: str, label: str, seconds: int, cond: str, min_buckets: int) -> str:
    return f""",
h AS (SELECT *, CAST(epoch(bucket) AS BIGINT) // {seconds}
               - row_number() OVER (PARTITION BY {label} ORDER BY bucket) AS isl
      FROM {src} WHERE {cond})
SELECT {label}, strftime(min(bucket), {TS}) AS start, strftime(max(bucket), {TS}) AS "last",
       count(*) AS buckets, CAST(sum(amount) AS BIGINT) AS amount
FROM h GROUP BY {label}, isl HAVING count(*) >= {min_buckets}"""


def _islands_out(df, label):
    return df.select(label, ts_text("start").alias("start"), ts_text("last").alias("last"),
                     "buckets", F.col("amount").cast("long").alias("amount"))


# ---------------------------------------------------------------- rates and alerts

@register("ingestion_rate", f"""
SELECT event_type, strftime(time_bucket(INTERVAL 5 MINUTE, ts), {TS}) AS bucket, count(*) AS records,
       round(count(*) / 300.0, 6) AS rate
FROM events GROUP BY ALL""")
def ingestion_rate(spark, sf_dir):
    """Records per source and 5-minute bucket, and the per-second rate."""
    r = mon.rate_per_bucket(table(spark, sf_dir, "events"), "ts", 300, ["event_type"])
    return r.select("event_type", ts_text("bucket").alias("bucket"), F.col("amount").alias("records"),
                    F.round("rate", 6).alias("rate"))


# Alert parameters (hourly error counts >= 4 for >= 3 consecutive hours).
_ERR_BUCKET, _ERR_MIN, _ERR_HOURS = 3600, 4, 3


@register("error_rate_alert", """
WITH b AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bucket, count(*) AS amount
           FROM events WHERE event_type = 'error' GROUP BY ALL)""" +
          _islands_sql("b", "event_type", _ERR_BUCKET, f"amount >= {_ERR_MIN}", _ERR_HOURS))
def error_rate_alert(spark, sf_dir):
    """A16 + R1 + W2: periods where the error rate stayed high for 3+ buckets."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    r = mon.rate_per_bucket(ev, "ts", _ERR_BUCKET, ["event_type"])
    return _islands_out(mon.sustained(r, ["event_type"], F.col("amount") >= _ERR_MIN, _ERR_BUCKET,
                                      _ERR_HOURS), "event_type")


@register("low_ingestion_alert", f"""
WITH b AS (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, count(*) AS amount
           FROM events GROUP BY ALL),
r AS (SELECT event_type, min(bucket) AS lo, time_bucket(INTERVAL 15 MINUTE, TIMESTAMP '{AS_OF}') AS hi FROM b GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS bucket FROM r),
f AS (SELECT g.event_type, g.bucket, coalesce(b.amount, 0) AS amount
      FROM g LEFT JOIN b ON g.event_type = b.event_type AND g.bucket = b.bucket)"""
          + _islands_sql("f", "event_type", 900, f"amount / 900.0 < {mon.MIN_INGESTION_PER_S}", 2))
def low_ingestion_alert(spark, sf_dir):
    """R6 + W2: ingestion below 10 records/s over 15 minutes for 15 minutes;
    empty buckets are generated up to ``as_of``, since silence is the lowest
    rate of all: a source that has stopped stays in alert."""
    r = mon.rate_per_bucket(table(spark, sf_dir, "events"), "ts", 900, ["event_type"])
    now = F.window(F.lit(AS_OF).cast("timestamp_ntz"), "900 seconds").start
    r = r.drop("rate").filter(F.col("bucket") <= F.lit(AS_OF).cast("timestamp_ntz"))
    f = mon.fill_buckets(r, ["event_type"], 900, end=now, fill={"amount": 0})
    cond = F.col("amount") / F.lit(900.0) < mon.MIN_INGESTION_PER_S
    return _islands_out(mon.sustained(f, ["event_type"], cond, 900, 2), "event_type")


def _runs(spark, sf_dir):
    return lineage.current_runs(fx.run_events(spark, sf_dir))


@register("success_rate", W(fx.RUNS_SQL) + f"""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, started_at), {TS}) AS bucket, count(*) AS runs,
       count(*) FILTER (WHERE status = 'success') AS successes,
       round(100.0 * count(*) FILTER (WHERE status = 'success') / count(*), 6) AS success_pct
FROM runs GROUP BY 1""")
def success_rate(spark, sf_dir):
    """Share of successful runs per 1-hour window, in percent."""
    r = _runs(spark, sf_dir)
    return (r.groupBy(mon.bucket("started_at", 3600).alias("b"))
            .agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("successes"))
            .select(ts_text("b").alias("bucket"), "runs", "successes",
                    F.round(F.col("successes") * 100.0 / F.col("runs"), 6).alias("success_pct")))


@register("failed_latest_runs", W(fx.RUNS_SQL) + f"""
SELECT pipeline_name, run_id, strftime(started_at, {TS}) AS started_at FROM (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY started_at DESC, run_id DESC) = 1)
WHERE status = 'failed'""")
def failed_latest_runs(spark, sf_dir):
    """R2: pipelines whose latest run failed."""
    ls = lineage.latest_status(_runs(spark, sf_dir))
    return ls.filter(F.col("status") == "failed").select(
        "pipeline_name", "run_id", ts_text("started_at").alias("started_at"))


@register("p95_duration_alert", W(fx.RUNS_SQL) + f""",
m AS (SELECT pipeline_name, date_trunc('month', started_at) AS bucket,
             quantile_cont(duration_s, 0.95) AS p95
      FROM runs WHERE status <> 'running' GROUP BY ALL),
h AS (SELECT *, (year(bucket) * 12 + month(bucket))
               - row_number() OVER (PARTITION BY pipeline_name ORDER BY bucket) AS isl
      FROM m WHERE p95 > {mon.SLOW_P95_SECONDS})
SELECT pipeline_name, strftime(min(bucket), {TS}) AS start, strftime(max(bucket), {TS}) AS "last",
       count(*) AS buckets, round(max(p95), 6) AS max_p95
FROM h GROUP BY pipeline_name, isl HAVING count(*) >= 2""")
def p95_duration_alert(spark, sf_dir):
    """A15 + R4 + W2: months where a pipeline's p95 run time exceeded 300 s,
    sustained for two consecutive months."""
    r = _runs(spark, sf_dir).filter(F.col("status") != "running").withColumn(
        "duration_s", epoch_seconds(F.col("completed_at")) - epoch_seconds(F.col("started_at")))
    p = mon.percentile_by(r.withColumn("bucket", F.date_trunc("month", "started_at")),
                          ["pipeline_name", "bucket"], "duration_s", 0.95)
    isl = mon.sustained(p, ["pipeline_name"], F.col("p95") > mon.SLOW_P95_SECONDS, None, 2,
                        extra=[F.round(F.max("p95"), 6).alias("max_p95")])
    return isl.select("pipeline_name", ts_text("start").alias("start"), ts_text("last").alias("last"),
                      "buckets", "max_p95")


@register("score_alert", W(fx.QUALITY_SQL) + f""",
s AS (SELECT table_name, "timestamp" AS ts, quality_id, (1 - error_rate) < {mon.MIN_QUALITY_SCORE} AS bad
      FROM qlog),
p AS (SELECT *, lag(bad) OVER (PARTITION BY table_name ORDER BY ts, quality_id) AS prev_bad FROM s),
t AS (SELECT * FROM p WHERE prev_bad IS NULL OR prev_bad <> bad),
n AS (SELECT *, lead(ts) OVER (PARTITION BY table_name ORDER BY ts, quality_id) AS next_ts FROM t)
SELECT table_name, strftime(ts, {TS}) AS start, strftime(next_ts, {TS}) AS "end",
       CAST(floor(epoch(coalesce(next_ts, TIMESTAMP '{AS_OF}'))) AS BIGINT)
         - CAST(floor(epoch(ts)) AS BIGINT) AS duration_s
FROM n WHERE bad AND CAST(floor(epoch(coalesce(next_ts, TIMESTAMP '{AS_OF}'))) AS BIGINT)
                     - CAST(floor(epoch(ts)) AS BIGINT) >= 600""")
def score_alert(spark, sf_dir):
    """Periods where a table's quality score stayed below 0.85 for 10+
    minutes (the score holds between check results)."""
    q = fx.quality_log(spark, sf_dir).withColumn("score", 1 - F.col("error_rate"))
    a = mon.gauge_below(q, "table_name", "timestamp", "score", mon.MIN_QUALITY_SCORE, 600,
                        tiebreak=["quality_id"], as_of=AS_OF)
    return a.select("table_name", ts_text("start").alias("start"), ts_text("end").alias("end"),
                    "duration_s")


@register("stale_datasets", W(fx.ACCESS_SQL) + f"""
SELECT table_name, strftime(max("timestamp"), {TS}) AS last_update,
       CAST(floor(epoch(TIMESTAMP '{AS_OF}')) AS BIGINT) - CAST(floor(epoch(max("timestamp"))) AS BIGINT) AS age_s,
       CAST(floor(epoch(TIMESTAMP '{AS_OF}')) AS BIGINT) - CAST(floor(epoch(max("timestamp"))) AS BIGINT)
         > {mon.STALE_AFTER_SECONDS} AS stale
FROM access WHERE access_type IN ('write', 'insert') GROUP BY 1""")
def stale_datasets(spark, sf_dir):
    """A17 + R5: last write per table and whether it is older than 2 hours."""
    w = fx.access_log(spark, sf_dir).filter(F.col("access_type").isin("write", "insert"))
    f = mon.freshness(w, "table_name", "timestamp", as_of=AS_OF)
    return f.select("table_name", ts_text("last_update").alias("last_update"), "age_s", "stale")


@register("dashboard_gold", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS records,
       count(*) FILTER (WHERE event_type = 'error') AS errors,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       round(count(*) FILTER (WHERE event_type = 'error') / 86400.0, 9) AS error_rate_per_s,
       CAST(round(sum(CAST(value AS DECIMAL(15,2))), 2) AS DOUBLE) AS total_value,
       count(DISTINCT user_id) AS active_users
FROM events GROUP BY 1""")
def dashboard_gold(spark, sf_dir):
    """One gold row per day: volume, errors, purchases, error rate, value."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_if(F.col("event_type") == "error").alias("errors"),
                 F.count_if(F.col("event_type") == "purchase").alias("purchases"),
                 F.round(F.count_if(F.col("event_type") == "error") / F.lit(86400.0), 9)
                 .alias("error_rate_per_s"),
                 gold.money(gold.units_sum(F.round(F.col("value") * 100).cast("long")), 100)
                 .alias("total_value"),
                 F.count_distinct("user_id").alias("active_users")))


@register("run_metrics", W(fx.RUNS_SQL) + """
SELECT pipeline_name, status, count(*) AS runs, CAST(sum(duration_s) AS BIGINT) AS total_duration_s,
       round(avg(duration_s), 6) AS avg_duration_s
FROM runs GROUP BY ALL""")
def run_metrics(spark, sf_dir):
    """Run counters and duration totals per pipeline and status."""
    r = fx.pipeline_runs(spark, sf_dir)
    return r.groupBy("pipeline_name", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("duration_s").alias("total_duration_s"),
        F.round(F.avg("duration_s"), 6).alias("avg_duration_s"))


@register("counter_increase", """
WITH s AS (SELECT user_id, ts, event_id, CAST(floor(value * 10) AS BIGINT) AS reading FROM events),
p AS (SELECT *, lag(reading) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM s)
SELECT user_id, count(*) AS samples,
       CAST(sum(CASE WHEN prev IS NULL THEN NULL WHEN reading < prev THEN reading ELSE reading - prev END)
            AS BIGINT) AS total_increase,
       count(*) FILTER (WHERE reading < prev) AS resets
FROM p GROUP BY 1""")
def counter_increase(spark, sf_dir):
    """Increase of a per-user counter with resets (what ``rate`` needs)."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.floor(F.col("value") * 10).cast("long").alias("reading"))
    inc = mon.counter_increase(ev, "user_id", "ts", "reading", ["event_id"])
    return inc.groupBy("user_id").agg(F.count(F.lit(1)).alias("samples"),
                                      F.sum("increase").alias("total_increase"),
                                      F.count_if("reset").alias("resets"))


# ---------------------------------------------------------------- metrics tables

@register("layer_metrics", W(fx.F1_SQL) + """,
ok AS (SELECT * FROM f1 WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
silver AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)
SELECT 'bronze' AS layer, 'record_count' AS metric, (SELECT count(*) FROM f1) AS value
UNION ALL SELECT 'bronze', 'null_count', (SELECT count(*) FROM f1 WHERE id IS NULL)
UNION ALL SELECT 'silver', 'validation_failures', (SELECT count(*) FROM f1) - (SELECT count(*) FROM ok)
UNION ALL SELECT 'silver', 'duplicates_removed', (SELECT count(*) FROM ok) - (SELECT count(*) FROM silver)
UNION ALL SELECT 'silver', 'record_count', (SELECT count(*) FROM silver)
UNION ALL SELECT 'gold', 'record_count', (SELECT count(DISTINCT coalesce(prio, 'unknown')) FROM silver)""")
def layer_metrics(spark, sf_dir):
    """The named per-layer metrics of one medallion run, long format."""
    L = f1_layers(spark, sf_dir)
    r = quality.retention_report(L.bronze, "id")
    nulls = L.bronze.agg(F.count_if(F.col("id").isNull()).alias("n"))
    g = L.gold.agg(F.count(F.lit(1)).alias("g"))
    return quality.one_row([r, nulls, g]).selectExpr(
        "stack(6, 'bronze', 'record_count', bronze_rows, 'bronze', 'null_count', n, "
        "'silver', 'validation_failures', ids_blank, 'silver', 'duplicates_removed', duplicates, "
        "'silver', 'record_count', silver_rows, 'gold', 'record_count', g) AS (layer, metric, value)")


@register("silver_preview", W(fx.F1_SQL) + """
SELECT ord, id, price FROM f1 WHERE price > 300000 ORDER BY ord LIMIT 20""")
def silver_preview(spark, sf_dir):
    """Pruned, filtered preview (column pruning + pushdown + top-k)."""
    b = fx.messy_orders(spark, sf_dir)
    return b.select("ord", "id", "price").filter(F.col("price") > 300000).orderBy("ord").limit(20)


@register("layer_sizes")
def layer_sizes(spark, sf_dir):
    """S6 + A12: files and size in MB per table of the folder (metadata only;
    sizes differ by writer, so checked for shape)."""
    f = list_files(spark, sf_dir, glob="*.parquet")
    return (f.groupBy(F.col("table").alias("table_name"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            .withColumn("size_mb", F.round(F.col("bytes") / F.lit(1048576.0), 2)))


@register("layer_source_metrics", W(fx.FLOWS_SQL) + f""",
m AS (SELECT split_part(target_table, '.', 2) AS layer, source_table AS source, '{mon.INGESTED_RECORDS}' AS metric,
             CAST(records_written AS DOUBLE) AS value FROM flows
      UNION ALL
      SELECT split_part(target_table, '.', 2), source_table, '{mon.INGESTED_BYTES}', CAST(bytes_written AS DOUBLE)
      FROM flows
      UNION ALL
      SELECT split_part(target_table, '.', 2), source_table, '{mon.PROCESSING_SECONDS}', duration_seconds FROM flows)
SELECT metric, layer, source, count(*) AS samples, round(sum(value), 6) AS total FROM m GROUP BY ALL""")
def layer_source_metrics(spark, sf_dir):
    """A13 + R8: ingestion records, bytes and processing time per layer and source."""
    return mon.accumulate(mon.flow_metrics(fx.data_flows(spark, sf_dir)))
