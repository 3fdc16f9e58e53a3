"""Catalogue entries: alert rules at their original windows and holds, dashboard panels
and named metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import epoch_seconds, ts_text
from strata.operators import lineage, monitoring as mon, quality
from strata.plans import fixtures as fx
from strata.plans.queries import AS_OF, register

W = fx.with_ctes
TS = "'%Y-%m-%d %H:%M:%S'"

# Windows and holds of the reference's alert rules, in seconds.
RATE_WINDOW, ERROR_HOLD, SLOW_HOLD, STALE_HOLD = 300, 300, 600, 300
STEP = 60


def _held_sql(src: str, label: str, cond: str, hold: int, extra: str) -> str:
    return f""",
h AS (SELECT *, CAST(epoch(bucket) AS BIGINT) // {STEP} - row_number() OVER (PARTITION BY {label} ORDER BY bucket) AS isl
      FROM {src} WHERE {cond})
SELECT {label}, strftime(min(bucket), {TS}) AS start, strftime(max(bucket), {TS}) AS "last", count(*) AS buckets, {extra}
FROM h GROUP BY {label}, isl HAVING count(*) > {hold // STEP}"""


_RATE_SQL = W(fx.DENSE_SQL) + f""",
p AS (SELECT layer AS component, ts, errors, lag(errors) OVER (PARTITION BY layer ORDER BY ts, sample_id) AS prev FROM dense),
s AS (SELECT component, time_bucket(INTERVAL {STEP} SECOND, ts) AS bucket,
             coalesce(sum(CASE WHEN prev IS NULL THEN NULL WHEN errors < prev THEN errors ELSE errors - prev END), 0) AS n
      FROM p GROUP BY ALL),
g AS (SELECT component, unnest(generate_series(min(bucket), max(bucket), INTERVAL {STEP} SECOND)) AS bucket FROM s GROUP BY 1),
f AS (SELECT g.component, g.bucket, coalesce(s.n, 0) AS n FROM g LEFT JOIN s ON s.component = g.component AND s.bucket = g.bucket),
r AS (SELECT component, bucket, CAST(sum(n) OVER (PARTITION BY component ORDER BY bucket
               RANGE BETWEEN INTERVAL {RATE_WINDOW - STEP} SECOND PRECEDING AND CURRENT ROW) AS BIGINT) AS amount FROM f)"""


def _error_rate(spark, sf_dir):
    return mon.sliding_rate(fx.error_counters(spark, sf_dir), ["component"], "ts", "errors", ["sample_id"],
                            window_s=RATE_WINDOW, step_s=STEP)


@register("error_rate_5m", _RATE_SQL + f"""
SELECT component, strftime(bucket, {TS}) AS bucket, amount, round(amount / {RATE_WINDOW}.0, 6) AS rate FROM r""")
def error_rate_5m(spark, sf_dir):
    """Errors per second over the last five minutes, at every minute."""
    return _error_rate(spark, sf_dir).select("component", ts_text("bucket").alias("bucket"),
                                             F.col("amount").cast("long").alias("amount"), F.round("rate", 6).alias("rate"))


@register("error_rate_5m_alert", _RATE_SQL + _held_sql(
    "r", "component", f"amount / {RATE_WINDOW}.0 > {mon.HIGH_ERROR_RATE_PER_S}", ERROR_HOLD,
    "CAST(max(amount) AS BIGINT) AS most"))
def error_rate_5m_alert(spark, sf_dir):
    """Over 0.1 errors a second over five minutes, for five minutes."""
    a = mon.held(_error_rate(spark, sf_dir), ["component"], F.col("rate") > mon.HIGH_ERROR_RATE_PER_S, STEP, ERROR_HOLD,
                 extra=[F.max("amount").cast("long").alias("most")])
    return a.select("component", ts_text("start").alias("start"), ts_text("last").alias("last"), "buckets", "most")


_P95_SQL = W(fx.DENSE_SQL) + f""",
s AS (SELECT layer, time_bucket(INTERVAL {STEP} SECOND, ts) AS bucket, seconds FROM dense),
m AS (SELECT layer, seconds, unnest(generate_series(bucket, bucket + INTERVAL {RATE_WINDOW - STEP} SECOND,
                                                    INTERVAL {STEP} SECOND)) AS bucket FROM s),
r AS (SELECT layer, bucket, count(*) AS samples, quantile_disc(seconds, 0.95) AS p95 FROM m GROUP BY ALL)"""


def _p95(spark, sf_dir):
    steps = mon.sketch_per_step(fx.processing_times(spark, sf_dir), ["layer"], "ts", "seconds", step_s=STEP)
    return mon.rolled_quantile(steps, ["layer"], 0.95, window_s=RATE_WINDOW, step_s=STEP)


@register("p95_by_layer", _P95_SQL + f"""
SELECT layer, strftime(bucket, {TS}) AS bucket, samples, p95 FROM r""")
def p95_by_layer(spark, sf_dir):
    """95th percentile of processing seconds per layer over the last five minutes,
    at every minute, merged from sketches of single minutes."""
    return _p95(spark, sf_dir).select("layer", ts_text("bucket").alias("bucket"), "samples", "p95")


@register("slow_layer_alert", _P95_SQL + _held_sql("r", "layer", f"p95 > {mon.SLOW_P95_SECONDS}", SLOW_HOLD,
                                                   "max(p95) AS max_p95"))
def slow_layer_alert(spark, sf_dir):
    """A layer's 95th percentile over 300 s for ten minutes."""
    a = mon.held(_p95(spark, sf_dir), ["layer"], F.col("p95") > mon.SLOW_P95_SECONDS, STEP, SLOW_HOLD,
                 extra=[F.max("p95").alias("max_p95")])
    return a.select("layer", ts_text("start").alias("start"), ts_text("last").alias("last"), "buckets", "max_p95")


_EPOCH = "CAST(floor(epoch({})) AS BIGINT)"


@register("stale_periods", W(fx.ACCESS_SQL) + f""",
n AS (SELECT table_name, "timestamp" AS ts, lead("timestamp") OVER (PARTITION BY table_name ORDER BY "timestamp", access_id) AS nxt
      FROM access WHERE access_type IN ('write', 'insert')),
d AS (SELECT *, {_EPOCH.format(f"coalesce(nxt, TIMESTAMP '{AS_OF}')")} - {_EPOCH.format('ts')} - {mon.STALE_AFTER_SECONDS} AS stale_s FROM n)
SELECT table_name, strftime(ts + INTERVAL {mon.STALE_AFTER_SECONDS} SECOND, {TS}) AS start, strftime(nxt, {TS}) AS "end", stale_s
FROM d WHERE stale_s >= {STALE_HOLD}""")
def stale_periods(spark, sf_dir):
    """When a table had no write for two hours and the five minutes after them."""
    w = fx.access_log(spark, sf_dir).filter(F.col("access_type").isin("write", "insert"))
    p = mon.stale_periods(w, "table_name", "timestamp", ["access_id"], as_of=AS_OF, hold_s=STALE_HOLD)
    return p.select("table_name", ts_text("start").alias("start"), ts_text("end").alias("end"), "stale_s")


# ---------------------------------------------------------------- dashboard and metrics

_RATE_PANEL, _SUCCESS_PANEL, _SCORE_PANEL, _P95_PANEL, _ERROR_PANEL = (
    "ingest_rate", "success_pct", "quality_score", "p95_seconds", "errors")


@register("dashboard_panels", W(fx.RUNS_SQL, fx.FLOWS_SQL, fx.QUALITY_SQL, fx.DENSE_SQL) + f"""
SELECT '{_RATE_PANEL}' AS panel, source_table AS label, strftime(date_trunc('day', "timestamp"), {TS}) AS bucket,
       round(CAST(sum(records_written) AS BIGINT) / 86400.0, 6) AS value FROM flows GROUP BY ALL
UNION ALL
SELECT '{_SUCCESS_PANEL}', pipeline_name, strftime(date_trunc('day', started_at), {TS}),
       round(100.0 * count(*) FILTER (WHERE status = 'success') / count(*) FILTER (WHERE status <> 'running'), 6)
FROM runs GROUP BY pipeline_name, date_trunc('day', started_at) HAVING count(*) FILTER (WHERE status <> 'running') > 0
UNION ALL
SELECT '{_SCORE_PANEL}', table_name, strftime(date_trunc('day', "timestamp"), {TS}),
       round(CAST(sum(passed_count) AS BIGINT) / CAST(sum(passed_count + failed_count) AS BIGINT), 6)
FROM qlog GROUP BY table_name, date_trunc('day', "timestamp") HAVING sum(passed_count + failed_count) > 0
UNION ALL
SELECT '{_P95_PANEL}', layer, strftime(date_trunc('hour', ts), {TS}), round(quantile_cont(seconds, 0.95), 6)
FROM dense GROUP BY layer, date_trunc('hour', ts)
UNION ALL
SELECT '{_ERROR_PANEL}', pipeline_name, strftime(date_trunc('day', started_at), {TS}),
       CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE)
FROM runs GROUP BY pipeline_name, date_trunc('day', started_at)""")
def dashboard_panels(spark, sf_dir):
    """The panels of the dashboard in one long table (panel, label, bucket, value):
    ingestion rate, success percentage, quality score, 95th percentile, errors."""
    def panel(df, name, label, value):
        return df.select(F.lit(name).alias("panel"), F.col(label).alias("label"), ts_text("b").alias("bucket"),
                         F.round(value, 6).cast("double").alias("value"))

    flows = fx.data_flows(spark, sf_dir).groupBy("source_table", F.date_trunc("day", "timestamp").alias("b")).agg(
        F.sum("records_written").alias("n"))
    runs = fx.pipeline_runs(spark, sf_dir).groupBy("pipeline_name", F.date_trunc("day", "started_at").alias("b")).agg(
        F.count_if(F.col("status") == "success").alias("good"), F.count_if(F.col("status") != "running").alias("ended"),
        F.count_if(F.col("status") == "failed").alias("failed"))
    score = fx.quality_log(spark, sf_dir).groupBy("table_name", F.date_trunc("day", "timestamp").alias("b")).agg(
        F.sum("passed_count").alias("p"), F.sum(F.col("passed_count") + F.col("failed_count")).alias("n")).filter("n > 0")
    slow = mon.percentile_by(fx.processing_times(spark, sf_dir).withColumn("b", F.date_trunc("hour", "ts")),
                             ["layer", "b"], "seconds", 0.95)
    parts = [panel(flows, _RATE_PANEL, "source_table", F.col("n") / F.lit(86400.0)),
             panel(runs.filter("ended > 0"), _SUCCESS_PANEL, "pipeline_name", F.col("good") * 100.0 / F.col("ended")),
             panel(score, _SCORE_PANEL, "table_name", F.col("p") / F.col("n")),
             panel(slow, _P95_PANEL, "layer", F.col("p95")),
             panel(runs, _ERROR_PANEL, "pipeline_name", F.col("failed").cast("double"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Metric names of the reference.
_METRICS = {"score": "lakehouse_data_quality_score", "failures": "lakehouse_validation_failures_total",
            "nulls": "lakehouse_null_count", "status": "lakehouse_pipeline_status",
            "success": "lakehouse_pipeline_success_total", "failed": "lakehouse_pipeline_failure_total",
            "updated": "lakehouse_last_update_timestamp", "records": "lakehouse_record_count"}
_NULL_COLUMNS = ("id", "prio", "status", "price")


@register("named_metrics", W(fx.RUNS_SQL, fx.QUALITY_SQL, fx.ACCESS_SQL, fx.REGISTRY_SQL, fx.F1_SQL) + f""",
cur AS (SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY version DESC) = 1),
lq AS (SELECT table_name, sum(failed_count) AS failures, max_by(1 - error_rate, struct_pack(a := "timestamp", b := quality_id)) AS score
       FROM qlog GROUP BY 1),
lr AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY started_at DESC, run_id DESC) = 1)
SELECT '{_METRICS["score"]}' AS metric, table_name AS label, '' AS detail, round(score, 6) AS value FROM lq
UNION ALL SELECT '{_METRICS["failures"]}', table_name, '', CAST(failures AS DOUBLE) FROM lq
UNION ALL SELECT '{_METRICS["status"]}', pipeline_name, status, 1.0 FROM lr
UNION ALL SELECT '{_METRICS["success"]}', pipeline_name, '', CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) FROM runs GROUP BY 2
UNION ALL SELECT '{_METRICS["failed"]}', pipeline_name, '', CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) FROM runs GROUP BY 2
UNION ALL SELECT '{_METRICS["updated"]}', table_name, '', CAST(floor(epoch(max("timestamp"))) AS DOUBLE)
          FROM access WHERE access_type IN ('write', 'insert') GROUP BY 2
UNION ALL SELECT '{_METRICS["records"]}', schema_name, '', CAST(coalesce(sum(row_count), 0) AS DOUBLE) FROM cur GROUP BY 2
""" + "".join(f"UNION ALL SELECT '{_METRICS['nulls']}', 'bronze.orders', '{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM f1\n"
              for c in _NULL_COLUMNS))
def named_metrics(spark, sf_dir):
    """The named metrics of the lakehouse, (metric, label, detail, value): latest
    quality score, failures, latest pipeline status and run counts, last update, records
    per layer and nulls per column."""
    from strata.operators import registry

    def rows(df, *metrics):
        return df.select(F.inline(F.array(*[F.struct(
            F.lit(_METRICS[m]).alias("metric"), F.col(label).cast("string").alias("label"),
            (F.col(detail) if detail else F.lit("")).alias("detail"), value.cast("double").alias("value"))
            for m, label, detail, value in metrics])))

    q = fx.quality_log(spark, sf_dir).groupBy("table_name").agg(
        F.max_by(1 - F.col("error_rate"), F.struct("timestamp", "quality_id")).alias("score"), F.sum("failed_count").alias("f"))
    runs = lineage.current_runs(fx.run_events(spark, sf_dir)).groupBy("pipeline_name").agg(
        F.max_by("status", F.struct("started_at", "run_id")).alias("status"),
        F.count_if(F.col("status") == "success").alias("good"), F.count_if(F.col("status") == "failed").alias("bad"))
    updated = (fx.access_log(spark, sf_dir).filter(F.col("access_type").isin("write", "insert"))
               .groupBy("table_name").agg(F.max("timestamp").alias("t")))
    layers = (registry.current_tables(fx.registry_versions(spark, sf_dir)).groupBy("schema_name")
              .agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n")))
    nulls = quality.null_profile(fx.messy_orders(spark, sf_dir), _NULL_COLUMNS).withColumn("table_name", F.lit("bronze.orders"))
    out = rows(q, ("score", "table_name", None, F.round("score", 6)), ("failures", "table_name", None, F.col("f")))
    for part in (rows(runs, ("status", "pipeline_name", "status", F.lit(1.0)), ("success", "pipeline_name", None, F.col("good")),
                      ("failed", "pipeline_name", None, F.col("bad"))),
                 rows(updated, ("updated", "table_name", None, epoch_seconds(F.col("t")))),
                 rows(layers, ("records", "schema_name", None, F.col("n"))),
                 rows(nulls, ("nulls", "table_name", "column_name", F.col("null_count")))):
        out = out.unionByName(part)
    return out
