"""Monitoring rules as table operators.

The reference evaluates PromQL over scraped metrics; here the same rules are
queries over fact tables (events, runs, logs):

* rates are counts per fixed bucket divided by the bucket length (exact,
  no PromQL extrapolation);
* a rule's ``for:`` duration is a gaps-and-islands pass over the *bucket
  summary* (one row per bucket and label), never over raw rows, so a label
  holding a third of the data costs one row per bucket;
* buckets with no data are generated with ``sequence`` where an empty bucket
  can satisfy the condition (low-rate rules).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import as_of_ts, epoch_seconds
from strata.operators.sequence import ROWS_PER_RANGE, next_in_sequence, previous_in_sequence, ranges_of

# Thresholds of the reference's alert rules.
HIGH_ERROR_RATE_PER_S = 0.1
MIN_QUALITY_SCORE = 0.85
SLOW_P95_SECONDS = 300
STALE_AFTER_SECONDS = 7200
MIN_INGESTION_PER_S = 10


def bucket(ts: str, seconds: int) -> Column:
    """Start of the fixed bucket of ``seconds`` containing ``ts``."""
    return F.window(F.col(ts), f"{seconds} seconds").start


def rate_per_bucket(df: DataFrame, ts: str, seconds: int, labels: Sequence[str] = (),
                    value: str | None = None) -> DataFrame:
    """Per label and bucket, the count (or sum of ``value``) and the
    per-second rate over the bucket."""
    amount = F.sum(value) if value else F.count(F.lit(1))
    return (df.groupBy(*labels, bucket(ts, seconds).alias("bucket"))
            .agg(amount.alias("amount"))
            .withColumn("rate", F.col("amount") / F.lit(float(seconds))))


def fill_buckets(summary: DataFrame, labels: Sequence[str], seconds: int, *,
                 start: Column | None = None, end: Column | None = None,
                 fill: dict | None = None) -> DataFrame:
    """Add the empty buckets between the first and last bucket (per label).

    The generated range is bounded by the time span / bucket length, not by
    the data volume.
    """
    labels = list(labels)
    rng = summary.groupBy(*labels).agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
    lo = start if start is not None else F.col("_lo")
    hi = end if end is not None else F.col("_hi")
    grid = rng.select(*labels, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {seconds} SECONDS")))
                      .alias("bucket"))
    out = grid.join(summary, [*labels, "bucket"], "left")
    return out.fillna(fill or {})


def bucket_index(bucket_col: str = "bucket", seconds: int | None = None) -> Column:
    """Consecutive integers for consecutive buckets: fixed-length buckets by
    their epoch offset, month buckets by year * 12 + month."""
    b = F.col(bucket_col)
    if seconds is None:
        return F.year(b) * 12 + F.month(b)
    return F.floor(epoch_seconds(b) / F.lit(seconds))


def sustained(summary: DataFrame, labels: Sequence[str], cond: Column, seconds: int | None,
              min_buckets: int, extra: Sequence[Column] = ()) -> DataFrame:
    """Islands of consecutive buckets where ``cond`` holds, at least
    ``min_buckets`` long: ``(labels, start, last, buckets)`` (``last`` = start
    of the island's last bucket) plus the summed ``amount`` when present.
    A missing bucket breaks an island.  ``seconds=None`` means month buckets.
    """
    labels = list(labels)
    hits = summary.filter(cond).withColumn("_idx", bucket_index("bucket", seconds))
    w = Window.partitionBy(*labels).orderBy("_idx")
    hits = hits.withColumn("_island", F.col("_idx") - F.row_number().over(w))
    aggs = [F.min("bucket").alias("start"), F.max("bucket").alias("last"),
            F.count(F.lit(1)).alias("buckets")]
    if "amount" in summary.columns:
        aggs.append(F.sum("amount").alias("amount"))
    aggs += list(extra)
    return (hits.groupBy(*labels, "_island").agg(*aggs)
            .filter(F.col("buckets") >= min_buckets).drop("_island"))


def percentile_by(df: DataFrame, labels: Sequence[str], col: str, q: float = 0.95,
                  exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """The q-quantile per label.

    ``exact`` uses ``percentile`` (linear interpolation, as DuckDB's
    ``quantile_cont``); its buffer is a value -> count map, so memory grows
    with *distinct* values per group (bounded for whole-second durations).
    Otherwise ``percentile_approx`` keeps a bounded sketch per group.
    """
    agg = (F.percentile(F.col(col), F.lit(q)) if exact
           else F.percentile_approx(F.col(col), q, accuracy))
    return df.groupBy(*labels).agg(agg.alias(f"p{int(q * 100)}"), F.count(F.lit(1)).alias("samples"))


# ---------------------------------------------------------------- sliding windows

def _grid_index(seconds: int) -> Column:
    return bucket_index("bucket", seconds)


def sliding_rate(samples: DataFrame, labels: Sequence[str], ts: str, value: str, tiebreak: Sequence[str] = (), *,
                 window_s: int = 300, step_s: int = 60, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The per-second rate of a counter over the last ``window_s`` seconds, on a
    fixed grid of ``step_s`` seconds: ``(labels, bucket, amount, rate)``, where the
    window ends with ``bucket``'s step.

    Increases are per sample and survive resets (:func:`counter_increase`); they are
    summed per step (partial aggregation), steps without samples count 0, and the
    window runs over the steps, never over samples.
    """
    labels = list(labels)
    inc = counter_increase(samples, labels, ts, value, tiebreak, rows_per_range=rows_per_range)
    steps = (inc.groupBy(*labels, bucket(ts, step_s).alias("bucket"))
             .agg(F.coalesce(F.sum("increase"), F.lit(0)).alias("step_amount")))
    grid = fill_buckets(steps, labels, step_s, fill={"step_amount": 0}).withColumn("_idx", _grid_index(step_s))
    w = Window.partitionBy(*labels).orderBy("_idx").rangeBetween(1 - window_s // step_s, 0)
    return (grid.withColumn("amount", F.sum("step_amount").over(w))
            .withColumn("rate", F.col("amount") / F.lit(float(window_s))).drop("_idx", "step_amount"))


def held(summary: DataFrame, labels: Sequence[str], cond: Column, step_s: int, hold_s: int,
         extra: Sequence[Column] = ()) -> DataFrame:
    """A rule's ``for:`` on a grid: periods whose evaluations all meet ``cond`` and that
    last ``hold_s`` seconds from the first to the last of them."""
    return sustained(summary, labels, cond, step_s, hold_s // step_s + 1, extra)


def sketch_per_step(df: DataFrame, labels: Sequence[str], ts: str, col: str, *, step_s: int = 60,
                    k: int = 400) -> DataFrame:
    """One mergeable quantile sketch (KLL, a few kilobytes whatever the rows) per
    label and step; rank errors are about 1.7 / k."""
    return (df.groupBy(*labels, bucket(ts, step_s).alias("bucket"))
            .agg(F.kll_sketch_agg_bigint(F.col(col).cast("long"), k).alias("sketch"), F.count(col).alias("samples"))
            .filter("samples > 0"))


def rolled_quantile(sketches: DataFrame, labels: Sequence[str], q: float, *, window_s: int = 300,
                    step_s: int = 60) -> DataFrame:
    """The quantile over the last ``window_s`` seconds at every step that has a
    sample in that window, from step sketches alone: each goes to the windows it is in
    (``window_s / step_s`` of them) and they are merged there.  No value is read again."""
    labels = list(labels)
    n = window_s // step_s
    ends = F.explode(F.sequence(F.col("bucket"), F.col("bucket") + F.expr(f"INTERVAL {step_s * (n - 1)} SECONDS"),
                                F.expr(f"INTERVAL {step_s} SECONDS"))).alias("bucket")
    return (sketches.select(*labels, ends, "sketch", "samples").groupBy(*labels, "bucket")
            .agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("samples").alias("samples"))
            .select(*labels, "bucket", "samples",
                    F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(q * 100)}")))


def stale_periods(df: DataFrame, label: str, ts: str, tiebreak: Sequence[str] = (), *, as_of=None,
                  max_age_s: int = STALE_AFTER_SECONDS, hold_s: int = 300) -> DataFrame:
    """R5 over time: when a dataset was stale for ``hold_s`` seconds: ``start`` is the
    moment its last update got older than ``max_age_s``, ``end`` the next update (null
    while it is still missing at ``as_of``)."""
    nxt = next_in_sequence(df.select(label, ts, *tiebreak), [label], ts, tiebreak, out_col="_next")
    stale_for = epoch_seconds(F.coalesce("_next", as_of_ts(as_of))) - epoch_seconds(F.col(ts)) - max_age_s
    return (nxt.withColumn("stale_s", stale_for).filter(F.col("stale_s") >= hold_s)
            .select(label, (F.col(ts) + F.expr(f"INTERVAL {max_age_s} SECONDS")).alias("start"),
                    F.col("_next").alias("end"), "stale_s"))


def gauge_below(samples: DataFrame, label: str, ts: str, value: str, threshold: float,
                min_seconds: int, tiebreak: Sequence[str] = (), as_of=None,
                bucket_unit: str | None = "auto", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Periods in which a gauge stayed below ``threshold`` for at least
    ``min_seconds``.

    A gauge holds its last sample until the next one.  A bad period starts at
    a sample below the threshold whose previous sample was not, and ends at
    the next sample that changes state (or ``as_of`` while still open).
    Previous / next samples come from the skew-safe sequence helpers; the cuts of
    heavy labels are found once, on the samples, and serve both.
    """
    tiebreak = list(tiebreak)
    s = samples.select(label, ts, *tiebreak, (F.col(value) < threshold).alias("_bad"))
    ranges = None if bucket_unit is None else ranges_of(s, [label], ts, tiebreak, rows_per_range)
    s = previous_in_sequence(s, [label], ts, tiebreak, value="_bad", out_col="_prev_bad",
                             bucket=bucket_unit, ranges=ranges)
    trans = s.filter(F.col("_prev_bad").isNull() | (F.col("_prev_bad") != F.col("_bad")))
    trans = next_in_sequence(trans, [label], ts, tiebreak, out_col="_next_ts", bucket=bucket_unit, ranges=ranges)
    end = F.coalesce(F.col("_next_ts"), as_of_ts(as_of))
    dur = epoch_seconds(end) - epoch_seconds(F.col(ts))
    return (trans.filter(F.col("_bad"))
            .select(label, F.col(ts).alias("start"), F.col("_next_ts").alias("end"),
                    dur.alias("duration_s"))
            .filter(F.col("duration_s") >= min_seconds))


def counter_increase(samples: DataFrame, label: str | Sequence[str], ts: str, value: str,
                     tiebreak: Sequence[str] = (), bucket_unit: str | None = "auto",
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per-sample increase of a counter that may reset: a drop means the
    counter restarted from zero, so the increase is the new value itself.
    The first sample of a series has no increase (null)."""
    labels = [label] if isinstance(label, str) else list(label)
    s = previous_in_sequence(samples, labels, ts, tiebreak, value=value, out_col="_prev",
                             bucket=bucket_unit, hot_rows=rows_per_range)
    inc = (F.when(F.col("_prev").isNull(), F.lit(None))
           .when(F.col(value) < F.col("_prev"), F.col(value))
           .otherwise(F.col(value) - F.col("_prev")))
    return s.withColumn("increase", inc).withColumn(
        "reset", F.coalesce(F.col(value) < F.col("_prev"), F.lit(False))).drop("_prev")


def freshness(df: DataFrame, label: str, ts: str, as_of=None,
              max_age_s: int = STALE_AFTER_SECONDS) -> DataFrame:
    """Last update per dataset and its age at ``as_of``."""
    last = df.groupBy(label).agg(F.max(ts).alias("last_update"))
    age = epoch_seconds(as_of_ts(as_of)) - epoch_seconds(F.col("last_update"))
    return last.withColumn("age_s", age).withColumn("stale", F.col("age_s") > max_age_s)


# Metric names the reference exports.
INGESTED_RECORDS = "lakehouse_ingestion_records_total"
INGESTED_BYTES = "lakehouse_ingestion_bytes_total"
PROCESSING_SECONDS = "lakehouse_processing_duration_seconds"


def flow_metrics(flows: DataFrame) -> DataFrame:
    """R8 / A13 input: the metric samples each data flow emits, long format
    ``(metric, layer, source, ts, value)``; ``layer`` is the target's layer,
    ``source`` the source table."""
    layer = F.split(F.col("target_table"), r"\.").getItem(1)
    samples = F.array(
        F.struct(F.lit(INGESTED_RECORDS).alias("metric"), F.col("records_written").cast("double").alias("value")),
        F.struct(F.lit(INGESTED_BYTES).alias("metric"), F.col("bytes_written").cast("double").alias("value")),
        F.struct(F.lit(PROCESSING_SECONDS).alias("metric"), F.col("duration_seconds").alias("value")))
    return flows.select(layer.alias("layer"), F.col("source_table").alias("source"),
                        F.col("timestamp").alias("ts"), F.inline(samples))


def accumulate(metrics: DataFrame, labels: Sequence[str] = ("metric", "layer", "source")) -> DataFrame:
    """Counters and durations accumulated per label set."""
    return metrics.groupBy(*labels).agg(F.count(F.lit(1)).alias("samples"),
                                        F.round(F.sum("value"), 6).alias("total"))
