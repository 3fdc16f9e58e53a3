"""Messy inputs derived from the benchmark tables.

The benchmark tables have no nulls, blank keys or duplicates, so these recipes
inject the defects the operators exist for.  Every recipe keeps every input
row (the modulo rules pick *which* rows get a defect, they never drop rows),
so the fixtures grow linearly with the tables.

Each fixture exists twice: a Spark builder (lazy DataFrame) and the same rule
as a DuckDB CTE for the independent SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table

# The reference's layer names and governance vocabularies.
LAYERS = ("bronze", "silver", "gold")
RUN_STATUS = {"F": "success", "P": "failed", "O": "running"}
ACCESS_TYPE = {"view": "read", "click": "read", "purchase": "write", "signup": "insert",
               "error": "scan"}
AUDIT_ACTION = {"view": "create_table", "click": "register_lineage", "purchase": "update_stats",
                "signup": "start_pipeline", "error": "complete_pipeline"}
AUDIT_RESOURCE = {"create_table": "table", "register_lineage": "transformation",
                  "update_stats": "table", "start_pipeline": "pipeline",
                  "complete_pipeline": "pipeline"}
CHECKS = {"click": ("id_completeness", "completeness"), "view": ("deduplication", "uniqueness"),
          "purchase": ("email_validity", "validity"), "signup": ("status_domain", "accepted_values"),
          "error": ("null_rate", "completeness")}


def _map_expr(col, mapping: dict) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out


def _sql_case(col: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


# ---------------------------------------------------------------- F1 messy orders

def _f1_id(k):
    return (F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.lit("  "))
            .otherwise(k.cast("string")))


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 bronze: ``ord`` = file-order ordinal, ``id`` with null / blank keys,
    and a second copy of every 7th order (status ``X``) later in file order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    base = o.select(k.alias("ord"), _f1_id(k).alias("id"), F.col("o_orderpriority").alias("prio"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    dups = o.filter(k % 7 == 0).select((k + 1_000_000_000).alias("ord"), _f1_id(k).alias("id"),
                                       F.col("o_orderpriority").alias("prio"),
                                       F.lit("X").alias("status"),
                                       F.col("o_totalprice").alias("price"))
    return base.unionByName(dups)


_F1_ID_SQL = ("CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '  ' "
              "ELSE CAST(o_orderkey AS VARCHAR) END")
F1_SQL = f"""f1 AS (
  SELECT o_orderkey AS ord, {_F1_ID_SQL} AS id, o_orderpriority AS prio,
         o_orderstatus AS status, o_totalprice AS price FROM orders
  UNION ALL
  SELECT o_orderkey + 1000000000, {_F1_ID_SQL}, o_orderpriority, 'X', o_totalprice
  FROM orders WHERE o_orderkey % 7 = 0)"""


# ---------------------------------------------------------------- F2 messy contacts

STATUS_BY_MOD5 = ("active", "inactive", "suspended", "Closed", None)
SOURCE_BY_MOD4 = ("crm", "erp", "website", "legacy")


def messy_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contacts with missing / empty / malformed emails and phones and
    out-of-domain statuses."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit(""))
             .when(k % 10 == 2, F.lit("no-at-sign"))
             .otherwise(F.concat(F.lit("  User"), k.cast("string"), F.lit("@Example.com "))))
    phone = (F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 9 == 1, F.lit("(5) 5-5 - 0 1"))
             .otherwise(F.concat(F.lit("("), (F.col("c_nationkey") + 100).cast("string"),
                                 F.lit(") 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))))
    status = F.lit(None).cast("string")
    for i, s in enumerate(STATUS_BY_MOD5):
        if s is not None:
            status = F.when(k % 5 == i, F.lit(s)).otherwise(status)
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCE_BY_MOD4]), (k % 4 + 1).cast("int"))
    return c.select(k.alias("customer_id"), F.col("c_name").alias("customer_name"),
                    email.alias("email"), phone.alias("phone"),
                    F.col("c_mktsegment").alias("segment"), status.alias("status"),
                    source.alias("source_system"), F.col("c_nationkey").alias("nation_key"))


F2_SQL = """f2 AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN ''
         WHEN c_custkey % 10 = 2 THEN 'no-at-sign'
         ELSE '  User' || CAST(c_custkey AS VARCHAR) || '@Example.com ' END AS email,
    CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN '(5) 5-5 - 0 1'
         ELSE '(' || CAST(c_nationkey + 100 AS VARCHAR) || ') 555-'
              || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
    c_mktsegment AS segment,
    CASE c_custkey % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' WHEN 2 THEN 'suspended'
         WHEN 3 THEN 'Closed' ELSE NULL END AS status,
    CASE c_custkey % 4 WHEN 0 THEN 'crm' WHEN 1 THEN 'erp' WHEN 2 THEN 'website'
         ELSE 'legacy' END AS source_system,
    c_nationkey AS nation_key
  FROM customer)"""


# ---------------------------------------------------------------- F3 runs and flows

def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 runs (wide form): one row per run; open runs have no completion."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = _map_expr(F.col("o_orderstatus"), RUN_STATUS)
    dur = (k % 600).cast("long")
    done = status != "running"
    return o.select(k.alias("run_id"),
                    F.concat(F.lit("p_"), (F.col("o_custkey") % 20).cast("string")).alias("pipeline_name"),
                    F.lit("batch").alias("run_type"), status.alias("status"),
                    F.col("o_orderdate").alias("started_at"),
                    F.when(done, F.col("o_orderdate") + F.make_dt_interval(secs=dur))
                    .alias("completed_at"),
                    dur.alias("duration_s"),
                    F.when(status == "failed", F.lit("boom")).alias("error_message"))


RUNS_SQL = """runs AS (
  SELECT o_orderkey AS run_id, 'p_' || CAST(o_custkey % 20 AS VARCHAR) AS pipeline_name,
         'batch' AS run_type,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' WHEN 'O' THEN 'running' END
           AS status,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_seconds(o_orderkey % 600) END
           AS completed_at,
         o_orderkey % 600 AS duration_s,
         CASE WHEN o_orderstatus = 'P' THEN 'boom' END AS error_message
  FROM orders)"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 runs as the append-only event log G7 writes: a ``running`` event at
    start, plus a final-status event at completion."""
    r = pipeline_runs(spark, sf_dir)
    start = r.select("run_id", "pipeline_name", "run_type", F.lit("running").alias("status"),
                     F.col("started_at").alias("event_ts"), F.lit(None).cast("string").alias("error_message"))
    end = r.filter(F.col("completed_at").isNotNull()).select(
        "run_id", "pipeline_name", "run_type", "status", F.col("completed_at").alias("event_ts"),
        "error_message")
    return start.unionByName(end)


RUN_EVENTS_SQL = """run_events AS (
  SELECT run_id, pipeline_name, run_type, 'running' AS status, started_at AS event_ts,
         CAST(NULL AS VARCHAR) AS error_message FROM runs
  UNION ALL
  SELECT run_id, pipeline_name, run_type, status, completed_at, error_message FROM runs
  WHERE completed_at IS NOT NULL)"""


def data_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 flows: one per line item; ``run_id`` negative (orphan) for every
    97th part, zero reads for every 50th part."""
    li = table(spark, sf_dir, "lineitem")
    zero = F.col("l_partkey") % 50 == 0
    read = F.when(zero, F.lit(0)).otherwise((F.col("l_quantity") * 10).cast("long"))
    written = F.when(zero, F.lit(0)).otherwise((F.col("l_quantity") * 9).cast("long"))
    sup = F.col("l_suppkey").cast("string")
    return li.select(
        F.when(F.col("l_partkey") % 97 == 0, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
        .alias("run_id"),
        F.concat(F.lit("lakehouse.bronze.t"), sup).alias("source_table"),
        F.concat(F.lit("lakehouse.silver.t"), sup).alias("target_table"),
        read.alias("records_read"), written.alias("records_written"),
        (read * 100).alias("bytes_read"), (written * 100).alias("bytes_written"),
        (F.col("l_tax") * 100).alias("duration_seconds"),
        F.col("l_shipdate").alias("timestamp"))


FLOWS_SQL = """flows AS (
  SELECT CASE WHEN l_partkey % 97 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS run_id,
         'lakehouse.bronze.t' || CAST(l_suppkey AS VARCHAR) AS source_table,
         'lakehouse.silver.t' || CAST(l_suppkey AS VARCHAR) AS target_table,
         CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(trunc(l_quantity * 10) AS BIGINT) END AS records_read,
         CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(trunc(l_quantity * 9) AS BIGINT) END AS records_written,
         100 * CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(trunc(l_quantity * 10) AS BIGINT) END AS bytes_read,
         100 * CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(trunc(l_quantity * 9) AS BIGINT) END AS bytes_written,
         l_tax * 100 AS duration_seconds, l_shipdate AS "timestamp"
  FROM lineitem)"""


# ---------------------------------------------------------------- F4 registry

def _layer_of(n) -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in LAYERS]), (n % 3 + 1).cast("int"))


def _fqn_of(n) -> F.Column:
    return F.concat(F.lit("lakehouse."), _layer_of(n), F.lit(".t"), n.cast("string"))


_LAYER_SQL = "CASE {n} % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END"


def _fqn_sql(n: str) -> str:
    return f"('lakehouse.' || {_LAYER_SQL.format(n=n)} || '.t' || CAST({n} AS VARCHAR))"


def registry_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """registry rows (append-only versions) for one table per part."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    common = [F.lit("lakehouse").alias("catalog_name"), _layer_of(n).alias("schema_name"),
              F.concat(F.lit("t"), n.cast("string")).alias("table_name"), _fqn_of(n).alias("full_name"),
              F.lit("parquet").alias("format")]
    v1 = p.select(*common, F.lit(1).alias("version"),
                  F.when(n % 13 == 0, F.lit(None).cast("long")).otherwise((F.col("p_size") * 100).cast("long"))
                  .alias("row_count"),
                  F.floor(F.col("p_retailprice") * 1024).cast("long").alias("size_bytes"),
                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    v2 = p.filter(n % 4 == 0).select(
        *common, F.lit(2).alias("version"), (F.col("p_size") * 150).cast("long").alias("row_count"),
        F.floor(F.col("p_retailprice") * 2048).cast("long").alias("size_bytes"),
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    return v1.unionByName(v2)


REGISTRY_SQL = f"""reg AS (
  SELECT 'lakehouse' AS catalog_name, {_LAYER_SQL.format(n='p_partkey')} AS schema_name,
         't' || CAST(p_partkey AS VARCHAR) AS table_name, {_fqn_sql('p_partkey')} AS full_name,
         'parquet' AS format, 1 AS version,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size * 100 AS BIGINT) END AS row_count,
         CAST(floor(p_retailprice * 1024) AS BIGINT) AS size_bytes,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM part
  UNION ALL
  SELECT 'lakehouse', {_LAYER_SQL.format(n='p_partkey')}, 't' || CAST(p_partkey AS VARCHAR),
         {_fqn_sql('p_partkey')}, 'parquet', 2, CAST(p_size * 150 AS BIGINT),
         CAST(floor(p_retailprice * 2048) AS BIGINT), TIMESTAMP '2024-01-02 00:00:00'
  FROM part WHERE p_partkey % 4 = 0)"""

COLUMN_TYPES = ("string", "bigint", "double")


def registry_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 columns: positions 0..p_size%5 per table, version 1 schema; version
    2 tables (every 4th) gain one column and retype position 0 to string."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    types = F.array(*[F.lit(t) for t in COLUMN_TYPES])
    v1 = (p.select(_fqn_of(n).alias("full_name"), F.lit(1).alias("version"),
                   F.explode(F.sequence(F.lit(0), F.col("p_size") % 5)).alias("position"))
          .withColumn("data_type", F.element_at(types, (F.col("position") % 3 + 1).cast("int"))))
    v2 = (p.filter(n % 4 == 0)
          .select(_fqn_of(n).alias("full_name"), F.lit(2).alias("version"),
                  F.explode(F.sequence(F.lit(0), F.col("p_size") % 5 + 1)).alias("position"))
          .withColumn("data_type", F.when(F.col("position") == 0, F.lit("string"))
                      .otherwise(F.element_at(types, (F.col("position") % 3 + 1).cast("int")))))
    return (v1.unionByName(v2)
            .withColumn("column_name", F.concat(F.lit("c"), F.col("position").cast("string")))
            .withColumn("nullable", F.col("position") != 0)
            .select("full_name", "version", "column_name", "data_type", "nullable", "position"))


REG_COLUMNS_SQL = f"""regcols AS (
  SELECT full_name, version, 'c' || CAST(position AS VARCHAR) AS column_name, data_type,
         position <> 0 AS nullable, position
  FROM (
    SELECT {_fqn_sql('p_partkey')} AS full_name, 1 AS version, CAST(g.position AS INTEGER) AS position,
           CASE g.position % 3 WHEN 0 THEN 'string' WHEN 1 THEN 'bigint' ELSE 'double' END AS data_type
    FROM part, LATERAL (SELECT unnest(range(0, p_size % 5 + 1)) AS position) g
    UNION ALL
    SELECT {_fqn_sql('p_partkey')}, 2, CAST(g.position AS INTEGER),
           CASE WHEN g.position = 0 THEN 'string'
                ELSE CASE g.position % 3 WHEN 0 THEN 'string' WHEN 1 THEN 'bigint' ELSE 'double' END END
    FROM part, LATERAL (SELECT unnest(range(0, p_size % 5 + 2)) AS position) g
    WHERE p_partkey % 4 = 0))"""


# ---------------------------------------------------------------- F5 lineage edges

def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t<n> -> t<n/3> (derive) for n > 0 and t<n> -> t<n/2> (join) for
    every 5th n; acyclic, with fan-in (a tree plus cross links)."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    derive = p.filter(n > 0).select(_fqn_of(n).alias("source_table"),
                                    _fqn_of(F.floor(n / 3).cast("long")).alias("target_table"),
                                    F.lit("derive").alias("transformation_type"),
                                    (ts + F.make_dt_interval(secs=n)).alias("created_at"))
    join = p.filter((n > 0) & (n % 5 == 0)).select(
        _fqn_of(n).alias("source_table"), _fqn_of(F.floor(n / 2).cast("long")).alias("target_table"),
        F.lit("join").alias("transformation_type"),
        (ts + F.make_dt_interval(secs=n + 1)).alias("created_at"))
    return (derive.unionByName(join)
            .withColumn("pipeline_name", F.lit("governed_pipeline")))


EDGES_SQL = f"""edges AS (
  SELECT {_fqn_sql('p_partkey')} AS source_table, {_fqn_sql('(p_partkey // 3)')} AS target_table,
         'derive' AS transformation_type, TIMESTAMP '2024-01-01' + to_seconds(p_partkey) AS created_at,
         'governed_pipeline' AS pipeline_name
  FROM part WHERE p_partkey > 0
  UNION ALL
  SELECT {_fqn_sql('p_partkey')}, {_fqn_sql('(p_partkey // 2)')}, 'join',
         TIMESTAMP '2024-01-01' + to_seconds(p_partkey + 1), 'governed_pipeline'
  FROM part WHERE p_partkey > 0 AND p_partkey % 5 = 0)"""


CHAIN_HUB, CHAIN_LENGTH = "lakehouse.bronze.hub", 20


def lineage_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 chains: the hub -> t<n> for every 20th n, t<n-1> -> t<n> for all others, so
    the tables stand in chains of 20 and the hub has a twentieth of all edges."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    source = F.when(n % CHAIN_LENGTH == 0, F.lit(CHAIN_HUB)).otherwise(_fqn_of(n - 1))
    return p.select(source.alias("source_table"), _fqn_of(n).alias("target_table"),
                    F.lit("derive").alias("transformation_type"), F.lit("chains").alias("pipeline_name"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"))


CHAINS_SQL = f"""chains AS (
  SELECT CASE WHEN p_partkey % {CHAIN_LENGTH} = 0 THEN '{CHAIN_HUB}' ELSE {_fqn_sql('(p_partkey - 1)')} END
           AS source_table, {_fqn_sql('p_partkey')} AS target_table
  FROM part)"""


# ---------------------------------------------------------------- F6 logs

def _event_table(eid) -> F.Column:
    return F.concat(F.lit("lakehouse.silver.t"), (eid % 20).cast("string"))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 data access log from events."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(eid.alias("access_id"), F.col("ts").alias("timestamp"),
                    F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
                    _event_table(eid).alias("table_name"),
                    _map_expr(F.col("event_type"), ACCESS_TYPE).alias("access_type"),
                    F.floor(F.col("value")).cast("long").alias("rows_affected"),
                    F.lit("success").alias("status"),
                    (eid % 1000).alias("duration_ms"))


ACCESS_SQL = f"""access AS (
  SELECT event_id AS access_id, ts AS "timestamp", 'user_' || CAST(user_id AS VARCHAR) AS "user",
         'lakehouse.silver.t' || CAST(event_id % 20 AS VARCHAR) AS table_name,
         {_sql_case('event_type', ACCESS_TYPE)} AS access_type,
         CAST(floor(value) AS BIGINT) AS rows_affected, 'success' AS status,
         event_id % 1000 AS duration_ms
  FROM events)"""


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 audit log from events: error events are failed actions."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    action = _map_expr(F.col("event_type"), AUDIT_ACTION)
    return e.select(eid.alias("audit_id"), F.col("ts").alias("timestamp"),
                    F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
                    action.alias("action"), _map_expr(action, AUDIT_RESOURCE).alias("resource_type"),
                    _event_table(eid).alias("resource_name"),
                    F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success"))
                    .alias("status"))


AUDIT_SQL = f"""audit AS (
  SELECT event_id AS audit_id, ts AS "timestamp", 'user_' || CAST(user_id AS VARCHAR) AS "user",
         {_sql_case('event_type', AUDIT_ACTION)} AS action,
         {_sql_case(_sql_case('event_type', AUDIT_ACTION), AUDIT_RESOURCE)} AS resource_type,
         'lakehouse.silver.t' || CAST(event_id % 20 AS VARCHAR) AS resource_name,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
  FROM events)"""


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 quality log from events: one check result per event."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    name = _map_expr(F.col("event_type"), {k: v[0] for k, v in CHECKS.items()})
    ctype = _map_expr(F.col("event_type"), {k: v[1] for k, v in CHECKS.items()})
    passed = F.col("user_id") * 10
    failed = F.floor(F.col("value")).cast("long") % 7
    status = F.when(failed == 0, "passed").when(failed < 3, "warning").otherwise("failed")
    return e.select(eid.alias("quality_id"), F.col("ts").alias("timestamp"),
                    _event_table(eid).alias("table_name"), name.alias("check_name"),
                    ctype.alias("check_type"), status.alias("status"),
                    passed.alias("passed_count"), failed.alias("failed_count"),
                    F.coalesce(F.try_divide(failed.cast("double"), (passed + failed).cast("double")),
                               F.lit(0.0)).alias("error_rate"))


QUALITY_SQL = f"""qlog AS (
  SELECT quality_id, "timestamp", table_name, check_name, check_type,
         CASE WHEN failed_count = 0 THEN 'passed' WHEN failed_count < 3 THEN 'warning' ELSE 'failed' END
           AS status,
         passed_count, failed_count,
         CASE WHEN passed_count + failed_count = 0 THEN 0.0
              ELSE failed_count / (passed_count + failed_count) END AS error_rate
  FROM (SELECT event_id AS quality_id, ts AS "timestamp",
               'lakehouse.silver.t' || CAST(event_id % 20 AS VARCHAR) AS table_name,
               {_sql_case('event_type', {k: v[0] for k, v in CHECKS.items()})} AS check_name,
               {_sql_case('event_type', {k: v[1] for k, v in CHECKS.items()})} AS check_type,
               user_id * 10 AS passed_count, CAST(floor(value) AS BIGINT) % 7 AS failed_count
        FROM events))"""


# ---------------------------------------------------------------- F7 dense samples

# Events two seconds apart from here on, so that rules over minutes have samples.
DENSE_START = "2024-01-01 00:00:00"


def _dense_ts() -> F.Column:
    return F.lit(DENSE_START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id") * 2)


def _dense_layer() -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in LAYERS]), (F.col("event_id") % 3 + 1).cast("int"))


def error_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """an error counter per layer that restarts every 1,000 events and grows at one
    of four speeds in between."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        eid.alias("sample_id"), _dense_layer().alias("component"), _dense_ts().alias("ts"),
        F.floor((eid % 1000) * (F.floor(eid / 1000) % 4) / 5).cast("long").alias("errors"))


def processing_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processing seconds per layer, slower in every second stretch of 2,000 events."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        eid.alias("sample_id"), _dense_layer().alias("layer"), _dense_ts().alias("ts"),
        ((eid * 7919) % 280 + 100 * (F.floor(eid / 2000) % 2)).cast("long").alias("seconds"))


DENSE_SQL = f"""dense AS (
  SELECT event_id AS sample_id, {_LAYER_SQL.format(n='event_id')} AS layer,
         TIMESTAMP '{DENSE_START}' + to_seconds(event_id * 2) AS ts,
         CAST((event_id % 1000) * ((event_id // 1000) % 4) // 5 AS BIGINT) AS errors,
         CAST((event_id * 7919) % 280 + 100 * ((event_id // 2000) % 2) AS BIGINT) AS seconds
  FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
