"""Catalogue entries: registry, lineage, runs and flows, audit logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import json_fields, json_text, ts_text
from strata.operators import audit, lineage, quality, registry
from strata.plans import fixtures as fx
from strata.plans.queries import AS_OF, register
from strata.session import scratch_path

W = fx.with_ctes
TS = "'%Y-%m-%d %H:%M:%S'"


# ---------------------------------------------------------------- registry

def _current(spark, sf_dir):
    return registry.current_tables(fx.registry_versions(spark, sf_dir))


_CUR_SQL = """,
cur AS (SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY version DESC) = 1)"""

_INFO_SQL = W(fx.REGISTRY_SQL, fx.REG_COLUMNS_SQL) + _CUR_SQL + """,
cc AS (SELECT c.full_name, string_agg(c.column_name || ':' || c.data_type, ',' ORDER BY c.position) AS columns
       FROM regcols c JOIN cur USING (full_name, version) GROUP BY c.full_name)
SELECT cur.full_name, schema_name, table_name, version, row_count, size_bytes, columns
FROM cur LEFT JOIN cc USING (full_name)"""


def _info_out(info):
    return info.select("full_name", "schema_name", "table_name", "version", "row_count", "size_bytes",
                       registry.columns_text().alias("columns"))


@register("registry_table_info", _INFO_SQL)
def registry_table_info(spark, sf_dir):
    """G3 + J1 + J2: current metadata of every table with its ordered columns."""
    info = registry.table_info(_current(spark, sf_dir), fx.registry_columns(spark, sf_dir))
    return _info_out(info)


@register("registry_export", _INFO_SQL)
def registry_export(spark, sf_dir):
    """The nested export rows (one per table, columns as a list)."""
    ex = registry.export_rows(_current(spark, sf_dir), fx.registry_columns(spark, sf_dir))
    return _info_out(ex)


@register("registry_restore", _INFO_SQL)
def registry_restore(spark, sf_dir):
    """Write the export as JSON, read it back, rebuild the table info."""
    path = scratch_path(spark, "export")
    registry.export_catalog(_current(spark, sf_dir), fx.registry_columns(spark, sf_dir), path)
    tables, cols = registry.restore_catalog(spark, path)
    return _info_out(registry.table_info(tables, cols))


@register("registry_current_stats", W(fx.REGISTRY_SQL) + _CUR_SQL + """
SELECT full_name, version, row_count, size_bytes, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM cur""")
def registry_current_stats(spark, sf_dir):
    """The newest statistics of every table (append-only versions)."""
    return _current(spark, sf_dir).select("full_name", "version", "row_count", "size_bytes",
                                          ts_text("updated_at").alias("updated_at"))


@register("registry_list_tables", W(fx.REGISTRY_SQL) + _CUR_SQL + """
SELECT table_name, full_name FROM cur WHERE schema_name = 'silver' ORDER BY table_name""")
def registry_list_tables(spark, sf_dir):
    """The tables of one layer, ordered by name."""
    return registry.list_tables(_current(spark, sf_dir), "silver").select("table_name", "full_name")


@register("governance_summary", W(fx.REGISTRY_SQL) + _CUR_SQL + """,
layers AS (SELECT * FROM (VALUES ('bronze'), ('silver'), ('gold')) t(schema_name))
SELECT coalesce(l.schema_name, '_total') AS layer, count(c.full_name) AS table_count,
       CAST(coalesce(sum(c.row_count), 0) AS BIGINT) AS total_records
FROM layers l LEFT JOIN cur c USING (schema_name) GROUP BY ROLLUP (l.schema_name)""")
def governance_summary(spark, sf_dir):
    """Tables and records per layer plus the total."""
    return registry.governance_summary(_current(spark, sf_dir))


@register("governance_tables", W(fx.REGISTRY_SQL) + _CUR_SQL + """
SELECT schema_name AS layer, table_name FROM cur WHERE schema_name IN ('bronze', 'silver', 'gold')""")
def governance_tables(spark, sf_dir):
    """The names behind the summary's counts, one row per table."""
    return registry.layer_tables(_current(spark, sf_dir))


@register("schema_diff", W(fx.REG_COLUMNS_SQL) + """,
o AS (SELECT full_name, column_name, data_type AS old_type FROM regcols WHERE version = 1),
n AS (SELECT full_name, column_name, data_type AS new_type FROM regcols WHERE version = 2),
j AS (SELECT coalesce(o.full_name, n.full_name) AS full_name, coalesce(o.column_name, n.column_name) AS column_name,
             old_type, new_type FROM o FULL JOIN n ON o.full_name = n.full_name AND o.column_name = n.column_name
      WHERE coalesce(o.full_name, n.full_name) IN (SELECT full_name FROM n))
SELECT full_name, column_name, old_type, new_type,
       CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'retyped' END AS change
FROM j WHERE old_type IS NULL OR new_type IS NULL OR old_type <> new_type""")
def schema_diff(spark, sf_dir):
    """Columns added / removed / retyped between each table's versions."""
    return registry.schema_diff(fx.registry_columns(spark, sf_dir)).select(
        "full_name", "column_name", "old_type", "new_type", "change")


# ---------------------------------------------------------------- lineage

def _walk_sql(start: str, direction: str, max_depth: int) -> str:
    near, far = ("target_table", "source_table") if direction == "upstream" else ("source_table", "target_table")
    return "WITH RECURSIVE " + fx.EDGES_SQL + f""",
reach(node, depth) AS (
  SELECT '{start}' AS node, 0 AS depth
  UNION
  SELECT e.{far}, r.depth + 1 FROM reach r JOIN edges e ON e.{near} = r.node WHERE r.depth < {max_depth}),
nodes AS (SELECT node, min(depth) AS depth FROM reach GROUP BY node)
SELECT e.source_table, e.target_table, e.transformation_type, e.pipeline_name,
       strftime(e.created_at, {TS}) AS created_at, n.depth
FROM nodes n JOIN edges e ON e.{near} = n.node"""


def _walk_out(df):
    return df.select("source_table", "target_table", "transformation_type", "pipeline_name",
                     ts_text("created_at").alias("created_at"), "depth")


_UP_START, _DOWN_START, _GRAPH_START = "lakehouse.bronze.t3", "lakehouse.bronze.t150", "lakehouse.silver.t7"


@register("lineage_upstream", _walk_sql(_UP_START, "upstream", 10))
def lineage_upstream(spark, sf_dir):
    """G9 + J5: every upstream edge of a table to depth 10 (frontier loop)."""
    return _walk_out(lineage.walk(fx.lineage_edges(spark, sf_dir), _UP_START, "upstream", max_depth=10))


@register("lineage_downstream", _walk_sql(_DOWN_START, "downstream", 10))
def lineage_downstream(spark, sf_dir):
    """G9 + J5: every downstream edge of a table to depth 10."""
    return _walk_out(lineage.walk(fx.lineage_edges(spark, sf_dir), _DOWN_START, "downstream", max_depth=10))


@register("lineage_graph", "WITH RECURSIVE " + fx.EDGES_SQL + f""",
up(node, depth) AS (
  SELECT '{_GRAPH_START}' AS node, 0 AS depth
  UNION
  SELECT e.source_table, r.depth + 1 FROM up r JOIN edges e ON e.target_table = r.node WHERE r.depth < 10),
down(node, depth) AS (
  SELECT '{_GRAPH_START}' AS node, 0 AS depth
  UNION
  SELECT e.target_table, r.depth + 1 FROM down r JOIN edges e ON e.source_table = r.node WHERE r.depth < 10),
nu AS (SELECT node, min(depth) AS depth FROM up GROUP BY node),
nd AS (SELECT node, min(depth) AS depth FROM down GROUP BY node)
SELECT e.source_table, e.target_table, e.transformation_type, e.pipeline_name,
       strftime(e.created_at, {TS}) AS created_at, n.depth, 'upstream' AS direction
FROM nu n JOIN edges e ON e.target_table = n.node
UNION ALL
SELECT e.source_table, e.target_table, e.transformation_type, e.pipeline_name,
       strftime(e.created_at, {TS}), n.depth, 'downstream'
FROM nd n JOIN edges e ON e.source_table = n.node""")
def lineage_graph(spark, sf_dir):
    """Both directions of one table (to depth 10), tagged with the direction."""
    g = lineage.lineage_graph(fx.lineage_edges(spark, sf_dir), _GRAPH_START, max_depth=10)
    return g.select(
        "source_table", "target_table", "transformation_type", "pipeline_name",
        ts_text("created_at").alias("created_at"), "depth", "direction")


@register("impact", "WITH RECURSIVE " + fx.EDGES_SQL + f""",
reach(node, depth) AS (
  SELECT '{_DOWN_START}' AS node, 0 AS depth
  UNION
  SELECT e.target_table, r.depth + 1 FROM reach r JOIN edges e ON e.source_table = r.node),
nodes AS (SELECT node, min(depth) AS depth FROM reach GROUP BY node)
SELECT e.target_table AS affected_table, min(n.depth) + 1 AS distance
FROM nodes n JOIN edges e ON e.source_table = n.node GROUP BY 1""")
def impact(spark, sf_dir):
    """Every table affected by a change to one table, with its distance."""
    return lineage.impact(fx.lineage_edges(spark, sf_dir), _DOWN_START)


@register("impact_chains", "WITH RECURSIVE " + fx.CHAINS_SQL + f""",
reach(node, depth) AS (
  SELECT '{fx.CHAIN_HUB}' AS node, 0 AS depth
  UNION
  SELECT e.target_table, r.depth + 1 FROM reach r JOIN chains e ON e.source_table = r.node)
SELECT node AS affected_table, CAST(min(depth) AS INTEGER) AS distance FROM reach WHERE depth > 0 GROUP BY 1""")
def impact_chains(spark, sf_dir):
    """G22 + J5: a hub that feeds the heads of chains of 20 tables each: all of them
    are affected, the last ones 20 steps away."""
    return lineage.impact(fx.lineage_chains(spark, sf_dir), fx.CHAIN_HUB)


# ---------------------------------------------------------------- runs and flows

@register("runs_current", W(fx.RUNS_SQL) + f"""
SELECT run_id, pipeline_name, status, strftime(started_at, {TS}) AS started_at,
       strftime(completed_at, {TS}) AS completed_at, error_message FROM runs""")
def runs_current(spark, sf_dir):
    """The current state of every run rebuilt from the append-only events."""
    cur = lineage.current_runs(fx.run_events(spark, sf_dir))
    return cur.select("run_id", "pipeline_name", "status", ts_text("started_at").alias("started_at"),
                      ts_text("completed_at").alias("completed_at"), "error_message")


@register("run_history", W(fx.RUNS_SQL) + """
SELECT pipeline_name, run_id, status, CAST(row_number() OVER (
         PARTITION BY pipeline_name ORDER BY started_at DESC, run_id DESC) AS INTEGER) AS rank
FROM runs QUALIFY rank <= 10""")
def run_history(spark, sf_dir):
    """The 10 newest runs of every pipeline in one job."""
    h = lineage.pipeline_history(lineage.current_runs(fx.run_events(spark, sf_dir)), None, 10)
    return h.select("pipeline_name", "run_id", "status", "rank")


@register("run_flow_stats", W(fx.FLOWS_SQL) + """
SELECT run_id, count(*) AS flows, CAST(sum(records_read) AS BIGINT) AS records_read,
       CAST(sum(records_written) AS BIGINT) AS records_written,
       CAST(sum(bytes_read) AS BIGINT) AS bytes_read, CAST(sum(bytes_written) AS BIGINT) AS bytes_written,
       round(sum(duration_seconds), 6) AS duration_seconds
FROM flows GROUP BY run_id""")
def run_flow_stats(spark, sf_dir):
    """Per-run flow totals."""
    return lineage.flow_stats(fx.data_flows(spark, sf_dir))


@register("flow_access_rows", W(fx.FLOWS_SQL) + f"""
SELECT run_id, strftime("timestamp", {TS}) AS "timestamp",
       CASE WHEN duration_seconds = 0 THEN NULL ELSE CAST(trunc(duration_seconds * 1000) AS BIGINT) END AS duration_ms,
       'read' AS access_type, source_table AS table_name, records_read AS rows_affected
FROM flows WHERE records_read <> 0
UNION ALL
SELECT run_id, strftime("timestamp", {TS}),
       CASE WHEN duration_seconds = 0 THEN NULL ELSE CAST(trunc(duration_seconds * 1000) AS BIGINT) END,
       'write', target_table, records_written
FROM flows WHERE records_written <> 0""")
def flow_access_rows(spark, sf_dir):
    """G8 + G14: the read / write access rows implied by each flow."""
    a = lineage.flow_access_rows(fx.data_flows(spark, sf_dir))
    return a.select("run_id", ts_text("timestamp").alias("timestamp"), "duration_ms", "access_type",
                    "table_name", "rows_affected")


@register("orphan_check", W(fx.RUNS_SQL, fx.FLOWS_SQL) + """
SELECT run_id, source_table, target_table, records_read FROM flows f
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.run_id = f.run_id)""")
def orphan_check(spark, sf_dir):
    """J6 + Q8: flows that point to no run (foreign keys are not enforced)."""
    o = quality.orphans_of(fx.data_flows(spark, sf_dir), fx.pipeline_runs(spark, sf_dir),
                           "run_id", "run_id")
    return o.select("run_id", "source_table", "target_table", "records_read")


# ---------------------------------------------------------------- logs

@register("audit_trail", W(fx.AUDIT_SQL) + f"""
SELECT audit_id, strftime("timestamp", {TS}) AS "timestamp", "user", action, status FROM audit
WHERE resource_name = 'lakehouse.silver.t3' AND "timestamp" >= TIMESTAMP '2024-01-05'
  AND "timestamp" <= TIMESTAMP '2024-01-25'
ORDER BY audit."timestamp" DESC, audit_id DESC LIMIT 100""")
def audit_trail(spark, sf_dir):
    """G15 + P9 + L1: one resource's newest 100 actions in a date range."""
    t = audit.audit_trail(fx.audit_log(spark, sf_dir), resource_name="lakehouse.silver.t3",
                          start="2024-01-05", end="2024-01-25", limit=100)
    return t.select("audit_id", ts_text("timestamp").alias("timestamp"), "user", "action", "status")


@register("access_history", W(fx.ACCESS_SQL) + f"""
SELECT access_id, strftime("timestamp", {TS}) AS "timestamp", "user", rows_affected FROM access
WHERE table_name = 'lakehouse.silver.t3' AND access_type = 'read'
ORDER BY access."timestamp" DESC, access_id DESC LIMIT 100""")
def access_history(spark, sf_dir):
    """Newest 100 reads of one table."""
    h = audit.access_history(fx.access_log(spark, sf_dir), table_name="lakehouse.silver.t3",
                             access_type="read", limit=100)
    return h.select("access_id", ts_text("timestamp").alias("timestamp"), "user", "rows_affected")


@register("quality_history", W(fx.QUALITY_SQL) + f"""
SELECT quality_id, strftime("timestamp", {TS}) AS "timestamp", check_name, failed_count FROM qlog
WHERE table_name = 'lakehouse.silver.t3' AND status = 'failed'
ORDER BY qlog."timestamp" DESC, quality_id DESC LIMIT 100""")
def quality_history(spark, sf_dir):
    """Newest 100 failed checks of one table."""
    h = audit.quality_history(fx.quality_log(spark, sf_dir), table_name="lakehouse.silver.t3",
                              status="failed", limit=100)
    return h.select("quality_id", ts_text("timestamp").alias("timestamp"), "check_name", "failed_count")


@register("access_summary", W(fx.ACCESS_SQL) + f""",
recent AS (SELECT * FROM access WHERE "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY),
t AS (SELECT table_name, access_type, count(*) AS "count", CAST(sum(rows_affected) AS BIGINT) AS total_rows,
             count(DISTINCT "user") AS type_users
      FROM recent GROUP BY 1, 2),
u AS (SELECT table_name, count(DISTINCT "user") AS unique_users, count(*) AS total_accesses
      FROM recent GROUP BY 1)
SELECT * FROM t JOIN u USING (table_name)""")
def access_summary(spark, sf_dir):
    """Per table and access type over the last 30 days, all tables."""
    return audit.access_summary(fx.access_log(spark, sf_dir), days=30, as_of=AS_OF)


@register("compliance_report", W(fx.AUDIT_SQL) + """
SELECT "user", resource_type, action, status, strftime("timestamp", '%Y-%m') AS month, count(*) AS actions
FROM audit GROUP BY ALL""")
def compliance_report(spark, sf_dir):
    """Actions per user, resource type, action, status and month."""
    return audit.compliance_report(fx.audit_log(spark, sf_dir))


@register("quality_trend", W(fx.QUALITY_SQL) + f""",
d AS (SELECT table_name, check_name, date_trunc('day', "timestamp") AS period, count(*) AS checks,
             avg(error_rate) AS error_rate, count(*) FILTER (WHERE status <> 'passed') AS not_passed
      FROM qlog GROUP BY ALL)
SELECT table_name, check_name, strftime(period, {TS}) AS period, checks, round(error_rate, 6) AS error_rate,
       not_passed,
       round(error_rate - lag(error_rate) OVER (PARTITION BY table_name, check_name ORDER BY period), 6) AS delta
FROM d""")
def quality_trend(spark, sf_dir):
    """Daily error rate per table and check, and its day-over-day change."""
    t = audit.quality_trend(fx.quality_log(spark, sf_dir))
    return t.select("table_name", "check_name", ts_text("period").alias("period"), "checks",
                    F.round("error_rate", 6).alias("error_rate"), "not_passed",
                    F.round("delta", 6).alias("delta"))


@register("table_card", W(fx.REGISTRY_SQL, fx.REG_COLUMNS_SQL, fx.EDGES_SQL, fx.ACCESS_SQL, fx.QUALITY_SQL)
          + _CUR_SQL + """,
cc AS (SELECT c.full_name, string_agg(c.column_name || ':' || c.data_type, ',' ORDER BY c.position) AS columns
       FROM regcols c JOIN cur USING (full_name, version) GROUP BY c.full_name),
up AS (SELECT target_table AS table_name, count(*) AS upstream_edges FROM edges GROUP BY 1),
dn AS (SELECT source_table AS table_name, count(*) AS downstream_edges FROM edges GROUP BY 1),
acc AS (SELECT table_name, string_agg(access_type || ':' || "user", ',' ORDER BY rk) AS latest_access
        FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY "timestamp" DESC, access_id DESC) AS rk
              FROM access) WHERE rk <= 5 GROUP BY 1),
chk AS (SELECT table_name, string_agg(check_name || ':' || status, ',' ORDER BY rk) AS latest_checks
        FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY "timestamp" DESC, quality_id DESC) AS rk
              FROM qlog) WHERE rk <= 5 GROUP BY 1)
SELECT cur.full_name AS table_name, schema_name, row_count, columns,
       CAST(coalesce(up.upstream_edges, 0) AS BIGINT) AS upstream_edges,
       CAST(coalesce(dn.downstream_edges, 0) AS BIGINT) AS downstream_edges, latest_access, latest_checks
FROM cur LEFT JOIN cc USING (full_name) LEFT JOIN up ON up.table_name = cur.full_name
LEFT JOIN dn ON dn.table_name = cur.full_name
LEFT JOIN acc ON acc.table_name = cur.full_name LEFT JOIN chk ON chk.table_name = cur.full_name""")
def table_card(spark, sf_dir):
    """G21 + W5: per table its metadata, columns, fan-in, 5 latest accesses and checks."""
    cur = _current(spark, sf_dir)
    info = registry.table_info(cur, fx.registry_columns(spark, sf_dir))
    edges = fx.lineage_edges(spark, sf_dir)
    up = (edges.groupBy(F.col("target_table").alias("table_name")).agg(F.count(F.lit(1)).alias("upstream_edges"))
          .join(edges.groupBy(F.col("source_table").alias("table_name"))
                .agg(F.count(F.lit(1)).alias("downstream_edges")), "table_name", "full_outer"))
    card = audit.table_card(info, registry.columns_text(), up, fx.access_log(spark, sf_dir),
                            fx.quality_log(spark, sf_dir))
    return card.select("table_name", "schema_name", "row_count", "columns", "upstream_edges",
                       "downstream_edges", "latest_access", "latest_checks")


@register("run_history_one", W(fx.RUNS_SQL) + f"""
SELECT run_id, status, strftime(started_at, {TS}) AS started_at FROM runs
WHERE pipeline_name = 'p_3' ORDER BY runs.started_at DESC, run_id DESC LIMIT 10""")
def run_history_one(spark, sf_dir):
    """G11 as the reference calls it: one pipeline's 10 newest runs."""
    h = lineage.pipeline_history(lineage.current_runs(fx.run_events(spark, sf_dir)), "p_3", 10)
    return h.select("run_id", "status", ts_text("started_at").alias("started_at"))


@register("audit_by_user", W(fx.AUDIT_SQL) + f"""
SELECT audit_id, strftime("timestamp", {TS}) AS "timestamp", action, resource_name, status FROM audit
WHERE "user" = 'user_7' ORDER BY audit."timestamp" DESC, audit_id DESC LIMIT 100""")
def audit_by_user(spark, sf_dir):
    """G15 + P9: one user's newest 100 actions over every resource."""
    t = audit.audit_trail(fx.audit_log(spark, sf_dir), user="user_7", limit=100)
    return t.select("audit_id", ts_text("timestamp").alias("timestamp"), "action", "resource_name", "status")


@register("referential_results", W(fx.RUNS_SQL, fx.FLOWS_SQL) + """,
c AS (SELECT count(*) FILTER (WHERE r.run_id IS NOT NULL) AS p, count(*) FILTER (WHERE r.run_id IS NULL) AS f
      FROM flows fl LEFT JOIN (SELECT DISTINCT run_id FROM runs) r ON fl.run_id = r.run_id)
SELECT 'data_flows' AS table_name, 'run_id_references_run_id' AS check_name, 'referential' AS check_type,
       CASE WHEN f = 0 THEN 'passed' ELSE 'failed' END AS status, p AS passed_count, f AS failed_count,
       round(CASE WHEN p + f = 0 THEN 0.0 ELSE f / (p + f) END, 6) AS error_rate
FROM c""")
def referential_results(spark, sf_dir):
    """Q8 + Q11: the referential-integrity check row (flows -> runs)."""
    return quality.referential_check(fx.data_flows(spark, sf_dir), fx.pipeline_runs(spark, sf_dir),
                                     "run_id", "run_id", "data_flows")


@register("run_flows_one", W(fx.FLOWS_SQL) + f"""
SELECT source_table, target_table, records_read, records_written, strftime("timestamp", {TS}) AS "timestamp"
FROM flows WHERE run_id = 7""")
def run_flows_one(spark, sf_dir):
    """G12 as the reference calls it: the flows of one run, by time."""
    f = fx.data_flows(spark, sf_dir).filter(F.col("run_id") == 7).orderBy("timestamp", "source_table")
    return f.select("source_table", "target_table", "records_read", "records_written",
                    ts_text("timestamp").alias("timestamp"))


@register("open_runs", W(fx.RUNS_SQL) + f"""
SELECT run_id, pipeline_name, strftime(started_at, {TS}) AS started_at,
       CAST(floor(epoch(TIMESTAMP '{AS_OF}')) AS BIGINT) - CAST(floor(epoch(started_at)) AS BIGINT) AS age_s
FROM runs WHERE status = 'running'
  AND CAST(floor(epoch(TIMESTAMP '{AS_OF}')) AS BIGINT) - CAST(floor(epoch(started_at)) AS BIGINT) > 3600""")
def open_runs(spark, sf_dir):
    """Runs without a completion event after the 60-minute limit."""
    o = lineage.open_runs(lineage.current_runs(fx.run_events(spark, sf_dir)), as_of=AS_OF, max_minutes=60)
    return o.select("run_id", "pipeline_name", ts_text("started_at").alias("started_at"), "age_s")


@register("table_card_edges", W(fx.EDGES_SQL) + """,
b AS (SELECT target_table AS table_name, 'u' AS side, source_table AS other, transformation_type AS kind, created_at FROM edges
      UNION ALL SELECT source_table, 'd', target_table, transformation_type, created_at FROM edges),
r AS (SELECT *, row_number() OVER (PARTITION BY table_name, side ORDER BY created_at DESC, other, kind) AS rk FROM b)
SELECT table_name,
       coalesce(string_agg(other || ' (' || kind || ')', ',' ORDER BY rk) FILTER (WHERE side = 'u'), '') AS upstream_tables,
       coalesce(string_agg(other || ' (' || kind || ')', ',' ORDER BY rk) FILTER (WHERE side = 'd'), '') AS downstream_tables
FROM r WHERE rk <= 5 GROUP BY 1""")
def table_card_edges(spark, sf_dir):
    """The lineage part of the table card: each table's newest direct edges."""
    return audit.card_edges(fx.lineage_edges(spark, sf_dir))


@register("access_details", W(fx.ACCESS_SQL) + """
SELECT table_name, count(*) AS rows, CAST(sum(rows_affected) AS BIGINT) AS rows_affected,
       CAST(max(duration_ms) AS BIGINT) AS longest_ms, count(*) FILTER (WHERE rows_affected % 5 = 0) AS without_duration
FROM (SELECT table_name, rows_affected, CASE WHEN rows_affected % 5 <> 0 THEN duration_ms END AS duration_ms FROM access)
GROUP BY 1""")
def access_details(spark, sf_dir):
    """details packed as JSON, null fields left out, and read back into columns."""
    log = fx.access_log(spark, sf_dir)
    ms = F.when(F.col("rows_affected") % 5 != 0, F.col("duration_ms"))
    packed = log.select("table_name", json_text({"rows": F.col("rows_affected"), "ms": ms}).alias("details"))
    d = packed.select("table_name", json_fields("details", "rows long, ms long").alias("d"))
    return d.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("d.rows").alias("rows_affected"), F.max("d.ms").alias("longest_ms"),
        F.count_if(F.col("d.ms").isNull()).alias("without_duration"))
