"""End-to-end layered flows (M1-M6) that write data and governance rows.

Each layer is one lazy plan written once; the next layer reads what was
written (never the plan that wrote it, so nothing is computed twice) and
counts come from ``Observation`` on the write.  The caller's session is used
as-is and never stopped.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import audit, gold, incremental, lineage, quality, registry, silver
from strata.operators.provenance import (AGGREGATED, PROCESSED, stamp_ingestion,
                                         stamp_source_system, stamp_time)
from strata.sinks.writers import write
from strata.sources.files import ORD, read_csv_strings, read_csv_typed


@dataclass
class FlowResult:
    paths: dict
    counts: dict
    run_id: int | None = None
    checks: list = field(default_factory=list)
    schemas: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)  # wall-clock time of each layer's stage
    metrics: dict = field(default_factory=dict)


def _size(spark: SparkSession, path: str) -> int:
    from strata.sinks.writers import _fs
    fs, p, _ = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


# ---------------------------------------------------------------- M1

def run_medallion(spark: SparkSession, source: str, dataset: str, group_by: str, root: str, *,
                  key: str = "id", fmt: str = "parquet", as_of: _dt.datetime | None = None) -> FlowResult:
    """M1: CSV -> bronze (stamped) -> silver (key present, first per key) ->
    gold (count per group + member table)."""
    root = root.rstrip("/")
    p = {"bronze": f"{root}/bronze/{dataset}", "silver": f"{root}/silver/{dataset}",
         "gold": f"{root}/gold/{dataset}_by_{group_by}",
         "gold_members": f"{root}/gold/{dataset}_by_{group_by}_members"}
    raw = read_csv_strings(spark, source)
    stamped = stamp_ingestion(raw, source, as_of=as_of)
    at = [time.time()]
    n_bronze = write(stamped, p["bronze"], fmt=fmt)
    at.append(time.time())
    bronze = spark.read.schema(stamped.schema).format(fmt).load(p["bronze"])
    s = stamp_time(silver.keep_first(silver.require_keys(bronze, key), key, ORD), PROCESSED, as_of=as_of)
    n_silver = write(s, p["silver"], fmt=fmt)
    at.append(time.time())
    sil = spark.read.schema(s.schema).format(fmt).load(p["silver"])
    g = stamp_time(gold.group_count(sil, group_by), AGGREGATED, as_of=as_of)
    n_gold = write(g, p["gold"], fmt=fmt)
    write(gold.group_members(sil, group_by, key, ORD), p["gold_members"], fmt=fmt)
    at.append(time.time())
    return FlowResult(paths=p, counts={"bronze": n_bronze, "silver": n_silver, "gold": n_gold},
                      seconds={k: b - a for k, a, b in zip(("bronze", "silver", "gold"), at, at[1:])},
                      schemas={"bronze": stamped.schema, "silver": s.schema, "gold": g.schema})


# ---------------------------------------------------------------- M2

def run_governed(spark: SparkSession, source: str, dataset: str, group_by: str, root: str,
                 gov_root: str, *, key: str = "id", user: str = "system", fmt: str = "parquet",
                 if_exists: str = "error", as_of: _dt.datetime | None = None) -> FlowResult:
    """M2: M1 with registration, lineage, run tracking, flows, access rows
    and quality checks.  A failure is recorded on the run and re-raised.

    With ``if_exists='error'`` registration is validated *before* any data is
    written, so a second run of the same dataset fails without touching the
    existing layers.  ``'replace'`` re-runs (for instance after a failed run)
    and registers new versions of the tables.
    """
    name = "governed_pipeline"
    layers = {"bronze": dataset, "silver": dataset, "gold": f"{dataset}_by_{group_by}"}
    current = registry.current_tables(registry.registry_tables(spark, gov_root))
    clash = current.filter(F.col("full_name").isin([registry.full_name(k, v) for k, v in layers.items()]))
    if if_exists == "error" and not clash.isEmpty():
        raise ValueError(f"already registered: {[r.full_name for r in clash.select('full_name').collect()]}")
    run_id = lineage.start_run(spark, gov_root, name, metadata={"dataset": dataset}, as_of=as_of)
    # Audit rows are buffered and written once per run (success or failure).
    actions = [audit.action_row(user, "start_pipeline", "pipeline", name, as_of=as_of)]
    try:
        res = run_medallion(spark, source, dataset, group_by, root, key=key, fmt=fmt, as_of=as_of)
        fq = {k: registry.full_name(k, v) for k, v in layers.items()}
        for layer, tname in layers.items():
            path = res.paths[layer]
            registry.register_table(spark, gov_root, layer, tname, location=path, schema=res.schemas[layer],
                                    fmt=fmt, row_count=res.counts[layer], size_bytes=_size(spark, path),
                                    if_exists=if_exists, as_of=as_of)
            actions.append(audit.action_row(user, "create_table", "table", fq[layer], as_of=as_of))
        for a, b, kind in (("bronze", "silver", "cleaning_and_deduplication"),
                           ("silver", "gold", "aggregation")):
            lineage.register_transformation(spark, gov_root, fq[a], fq[b], kind, name, as_of=as_of)
            actions.append(audit.action_row(user, "register_lineage", "transformation",
                                            f"{fq[a]} -> {fq[b]}", as_of=as_of))
        src_fq = f"lakehouse.external.{source.rstrip('/').split('/')[-1].rsplit('.', 1)[0]}"
        # Each stage with the rows, bytes and seconds of its own write.
        stages = [("external", "bronze"), ("bronze", "silver"), ("silver", "gold")]
        names = fq | {"external": src_fq}
        rows = res.counts | {"external": res.counts["bronze"]}
        size = {k: _size(spark, res.paths[k]) for k in layers} | {"external": _size(spark, source)}
        lineage.record_flows(spark, gov_root, [
            lineage.flow_row(run_id, names[a], names[b], rows[a], rows[b], size[a], size[b],
                             duration_seconds=res.seconds[b], as_of=as_of) for a, b in stages], user)
        bronze = spark.read.schema(res.schemas["bronze"]).format(fmt).load(res.paths["bronze"])
        checks = quality.run_checks(bronze, fq["silver"], [quality.completeness(key), quality.uniqueness(key)],
                                    details=True)
        res.checks = [r.asDict() for r in checks.collect()]  # two rows
        audit.log_quality(spark.createDataFrame(res.checks, checks.schema), gov_root, as_of=as_of)
        lineage.complete_run(spark, gov_root, run_id, name, "success", as_of=as_of)
        actions.append(audit.action_row(user, "complete_pipeline", "pipeline", name, as_of=as_of))
        audit.log_actions(spark, gov_root, actions)
        res.run_id = run_id
        return res
    except Exception as e:
        lineage.complete_run(spark, gov_root, run_id, name, "failed", error_message=str(e), as_of=as_of)
        actions.append(audit.action_row(user, "complete_pipeline", "pipeline", name, status="failed",
                                        as_of=as_of))
        audit.log_actions(spark, gov_root, actions)
        raise


# ---------------------------------------------------------------- M3 / M6

def run_spark_layers(spark: SparkSession, source: str, source_name: str, group_by: str, root: str, *,
                     fmt: str = "parquet", required: list[str] | str | None = None,
                     min_score: float | None = None, ordered: bool = False) -> FlowResult:
    """M3 (M5 with ``required='any'`` and ``ordered``; M6 with ``min_score``):
    typed CSV appended to bronze, whole-row distinct + required columns to
    silver (overwrite), group count to gold (by count descending if ordered).

    With ``min_score`` the silver/bronze retention gate (Q5) runs between
    silver and gold and raises before gold is written.
    """
    root = root.rstrip("/")
    p = {"bronze": f"{root}/bronze", "silver": f"{root}/silver", "gold": f"{root}/gold"}
    raw = read_csv_typed(spark, source)
    b = stamp_source_system(stamp_ingestion(raw, source), source_name)
    write(b, p["bronze"], fmt=fmt, mode="append")
    bronze = spark.read.format(fmt).load(p["bronze"])
    s = silver.distinct_rows(bronze.drop("_source_file"))
    if required:
        s = silver.drop_nulls(s, None if required == "any" else required)
    n_silver = write(stamp_time(s, PROCESSED), p["silver"], fmt=fmt)
    n_bronze = bronze.count()
    report = spark.createDataFrame([(n_bronze, n_silver)], "bronze_rows long, silver_rows long") \
        .withColumn("retention", F.round(quality.layer_ratio(F.col("silver_rows"), F.col("bronze_rows")), 6))
    counts = {"bronze": n_bronze, "silver": n_silver}
    if min_score is not None:
        quality.enforce(quality.score_gate(report, min_score), "quality score")
    sil = spark.read.format(fmt).load(p["silver"])
    g = gold.group_count(sil, group_by, missing=None)
    if ordered:
        g = g.orderBy(F.col("count").desc(), F.col(group_by))
    counts["gold"] = write(stamp_time(g, AGGREGATED), p["gold"], fmt=fmt)
    # M6's last step: the run's metrics, from the counts of the writes
    metrics = {f"{k}_records": float(v) for k, v in counts.items()}
    metrics["retention"] = round(n_silver / n_bronze, 6) if n_bronze else 0.0
    write(spark.createDataFrame([(k, v, source_name) for k, v in sorted(metrics.items())],
                                "metric string, value double, source string").coalesce(1)
          .withColumn("collected_at", F.localtimestamp()), f"{root}/metrics", mode="append")
    return FlowResult(paths=p, counts=counts, metrics=metrics)


# ---------------------------------------------------------------- M4

def silver_contacts_model(source: DataFrame, target: DataFrame | None, *, key: str = "customer_id",
                          ts_col: str = "ingestion_timestamp") -> DataFrame:
    """M4: the incremental silver contact model: new rows since the target's
    newest, latest per key, cleaned and flagged, merged on the key."""
    if target is None:
        new = silver.keep_latest(source, key, [ts_col])
    else:
        # Only rows newer than the target's newest (all of them when the
        # target is empty - a plain ``>`` against NULL would select none)
        wm = target.agg(F.max(ts_col)).scalar()
        new = silver.keep_latest(source.filter(wm.isNull() | (F.col(ts_col) > wm)), key, [ts_col])
    clean = silver.normalise_contacts(new, key=key, processed_ts=F.localtimestamp())
    return clean if target is None else incremental.merge_upsert(target, clean, key)
