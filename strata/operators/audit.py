"""Audit, access and quality logs.

Logs are append-only tables; in storage they are partitioned by date so a
time-range filter prunes whole folders.  Every reader is an optional-filter
query: each given argument adds one predicate, which Catalyst pushes to the
scan.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import as_of_ts

# Action / status vocabularies of the reference.
ACTIONS = ("create_table", "register_lineage", "start_pipeline", "complete_pipeline",
           "update_stats", "export_catalog")
ACTION_STATUS = ("success", "failed", "denied")
CHECK_STATUS = ("passed", "failed", "warning")

AUDIT_SCHEMA = T.StructType([
    T.StructField("audit_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("user", T.StringType()),
    T.StructField("action", T.StringType()), T.StructField("resource_type", T.StringType()),
    T.StructField("resource_name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("details", T.StringType()), T.StructField("ip_address", T.StringType()),
    T.StructField("session_id", T.StringType()), T.StructField("date", T.DateType()),
])


def new_id() -> str:
    """A unique log id that sorts by the time it was made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def action_row(user: str, action: str, resource_type: str, resource_name: str,
               status: str = "success", details: dict | None = None,
               as_of: _dt.datetime | None = None, ip_address: str | None = None,
               session_id: str | None = None) -> tuple:
    """One audit row (G13) for :func:`log_actions`."""
    ts = as_of or _dt.datetime.now()
    return (new_id(), ts, user, action, resource_type, resource_name, status,
            json.dumps(details) if details is not None else None, ip_address, session_id, ts.date())


def log_actions(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Append audit rows in one write (one file per date, not per row)."""
    if rows:
        (spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append")
         .partitionBy("date").parquet(f"{root}/audit_log"))


def log_action(spark: SparkSession, root: str, user: str, action: str, resource_type: str,
               resource_name: str, status: str = "success", details: dict | None = None,
               as_of: _dt.datetime | None = None) -> None:
    """Append one audit row (date-partitioned)."""
    log_actions(spark, root, [action_row(user, action, resource_type, resource_name, status,
                                         details, as_of)])


def _optional_filters(df: DataFrame, eq: dict, ts_col: str = "timestamp", start=None,
                      end=None) -> DataFrame:
    """One predicate per given argument; the time range is inclusive."""
    for c, v in eq.items():
        if v is not None:
            df = df.filter(F.col(c) == F.lit(v))
    if start is not None:
        df = df.filter(F.col(ts_col) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(ts_col) <= F.lit(str(end)).cast("timestamp_ntz"))
    return df


def _newest(df: DataFrame, limit: int | None, id_col: str) -> DataFrame:
    """L1: newest first, unique tie-break, optional limit (TakeOrderedAndProject)."""
    out = df.orderBy(F.col("timestamp").desc(), F.col(id_col).desc())
    return out.limit(limit) if limit else out


def audit_trail(log: DataFrame, resource_name=None, user=None, start=None, end=None,
                limit: int | None = 100) -> DataFrame:
    """G15."""
    return _newest(_optional_filters(log, {"resource_name": resource_name, "user": user},
                                     start=start, end=end), limit, "audit_id")


def access_history(log: DataFrame, table_name=None, user=None, access_type=None,
                   limit: int | None = 100) -> DataFrame:
    """G16."""
    return _newest(_optional_filters(log, {"table_name": table_name, "user": user,
                                           "access_type": access_type}), limit, "access_id")


def quality_history(log: DataFrame, table_name=None, check_type=None, status=None,
                    limit: int | None = 100) -> DataFrame:
    """G17."""
    return _newest(_optional_filters(log, {"table_name": table_name, "check_type": check_type,
                                           "status": status}), limit, "quality_id")


def access_summary(log: DataFrame, days: int = 30, as_of=None, table_name: str | None = None) -> DataFrame:
    """G18 / A9 for every table at once: per (table, access type) the count,
    rows and distinct users, with the table's distinct users and total
    accesses.

    One scan: the log is first reduced to (table, type, user), then to both
    levels at once; a table's totals reach its type rows by a window over that
    summary.
    """
    since = as_of_ts(as_of) - F.make_dt_interval(days=F.lit(days))
    recent = log.filter(F.col("timestamp") >= since)
    if table_name is not None:
        recent = recent.filter(F.col("table_name") == table_name)
    per_user = recent.groupBy("table_name", "access_type", "user").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rows_affected").alias("r"))
    levels = per_user.groupingSets([["table_name", "access_type"], ["table_name"]], "table_name", "access_type").agg(
        F.grouping("access_type").alias("_whole"), F.sum("n").alias("count"), F.sum("r").alias("total_rows"),
        F.count_distinct("user").alias("type_users"))
    table = Window.partitionBy("table_name")

    def whole(c):
        return F.max(F.when(F.col("_whole") == 1, F.col(c))).over(table)
    return (levels.withColumn("unique_users", whole("type_users")).withColumn("total_accesses", whole("count"))
            .filter("_whole = 0").drop("_whole"))


def latest_per_entity(log: DataFrame, entity: str, n: int = 5, id_col: str | None = None) -> DataFrame:
    """The newest ``n`` rows of every entity in one job (partial group
    limit before the shuffle)."""
    order = [F.col("timestamp").desc()] + ([F.col(id_col).desc()] if id_col else [])
    w = Window.partitionBy(entity).orderBy(*order)
    return log.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def compliance_report(audit: DataFrame) -> DataFrame:
    """Actions per user, resource type, action, status and month."""
    return audit.groupBy("user", "resource_type", "action", "status",
                         F.date_format("timestamp", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("actions"))


def quality_trend(qlog: DataFrame, bucket: str = "day") -> DataFrame:
    """Per table, check and day: mean error rate and its change since the
    previous day with results.  The window runs over the daily aggregate
    (one row per day per check), not over raw log rows."""
    daily = (qlog.groupBy("table_name", "check_name",
                          F.date_trunc(bucket, "timestamp").alias("period"))
             .agg(F.count(F.lit(1)).alias("checks"), F.avg("error_rate").alias("error_rate"),
                  F.count_if(F.col("status") != "passed").alias("not_passed")))
    w = Window.partitionBy("table_name", "check_name").orderBy("period")
    return daily.withColumn("delta", F.col("error_rate") - F.lag("error_rate").over(w))


def table_card(current: DataFrame, columns_text: Column, upstream_counts: DataFrame,
               access: DataFrame, qlog: DataFrame, n: int = 5) -> DataFrame:
    """One row per table: metadata, column list, direct lineage (edge
    counts per table, from ``upstream_counts``) and its ``n`` latest
    accesses and checks (as ordered text lists)."""
    acc = (latest_per_entity(access, "table_name", n, "access_id")
           .groupBy("table_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
               F.struct("rank", F.concat_ws(":", "access_type", "user").alias("v")))),
               lambda x: x["v"]), ",").alias("latest_access")))
    chk = (latest_per_entity(qlog, "table_name", n, "quality_id")
           .groupBy("table_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
               F.struct("rank", F.concat_ws(":", "check_name", "status").alias("v")))),
               lambda x: x["v"]), ",").alias("latest_checks")))
    base = current.select(F.col("full_name").alias("table_name"), "schema_name", "row_count",
                          columns_text.alias("columns"))
    out = (base.join(upstream_counts, "table_name", "left")
           .join(acc, "table_name", "left").join(chk, "table_name", "left"))
    for c in ("upstream_edges", "downstream_edges"):
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(c, F.lit(0)).cast("long"))
    return out


def card_edges(edges: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest direct edges of each table in both directions, as ordered
    text lists ``table (transformation)`` (the top-k is cut before the shuffle)."""
    ends = F.inline(F.array(
        F.struct(F.col("target_table").alias("table_name"), F.lit("upstream").alias("side"), F.col("source_table").alias("other")),
        F.struct(F.col("source_table").alias("table_name"), F.lit("downstream").alias("side"), F.col("target_table").alias("other"))))
    w = Window.partitionBy("table_name", "side").orderBy(F.col("created_at").desc(), "other", "transformation_type")
    top = (edges.select("transformation_type", "created_at", ends).withColumn("rank", F.row_number().over(w))
           .filter(F.col("rank") <= n))
    text = F.concat(F.col("other"), F.lit(" ("), F.col("transformation_type"), F.lit(")")).alias("v")

    def side(name):
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == name, F.struct("rank", text)))),
                                        lambda x: x["v"]), ",").alias(f"{name}_tables")
    return top.groupBy("table_name").agg(side("upstream"), side("downstream"))


ACCESS_SCHEMA = T.StructType([
    T.StructField("access_id", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("user", T.StringType()),
    T.StructField("table_name", T.StringType()), T.StructField("access_type", T.StringType()),
    T.StructField("rows_affected", T.LongType()), T.StructField("query", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("duration_ms", T.LongType()),
    T.StructField("details", T.StringType()),
])


def log_access(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Append data-access rows ``(timestamp, user, table_name,
    access_type, rows_affected, query, status, duration_ms, details)`` in one
    write; each row gets an ``access_id``."""
    if rows:
        append_log(spark.createDataFrame([(new_id(), *r) for r in rows], ACCESS_SCHEMA),
                   f"{root}/data_access_log")


def row_id() -> Column:
    """A unique id per row of a DataFrame, sorting by the time of the write."""
    return F.concat(F.lit(f"{time.time_ns():020d}-"), F.uuid())


def append_log(rows: DataFrame, path: str) -> None:
    """Append log rows partitioned by ``date`` (from ``timestamp``): time-range
    readers prune whole folders; few files per date per write, and a date that
    holds most rows is split over several tasks."""
    (rows.withColumn("date", F.to_date("timestamp")).hint("rebalance", F.col("date")).write
     .mode("append").partitionBy("date").parquet(path))


QUALITY_SCHEMA = T.StructType([
    T.StructField("quality_id", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("table_name", T.StringType()),
    T.StructField("check_name", T.StringType()), T.StructField("check_type", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("passed_count", T.LongType()),
    T.StructField("failed_count", T.LongType()), T.StructField("error_rate", T.DoubleType()),
    T.StructField("details", T.StringType()),
])


def log_quality(results: DataFrame, root: str, as_of: _dt.datetime | None = None) -> None:
    """G13 quality side: append check-result rows (Q11 shape, with ``details``
    where the check gives them) to the log; each row gets a ``quality_id``."""
    ts = F.lit(as_of or _dt.datetime.now()).cast("timestamp_ntz")
    details = F.col("details") if "details" in results.columns else F.lit(None)
    append_log(results.select(row_id().alias("quality_id"), ts.alias("timestamp"), "table_name", "check_name",
                              "check_type", "status", "passed_count", "failed_count", "error_rate",
                              details.cast("string").alias("details")), f"{root}/quality_log")
