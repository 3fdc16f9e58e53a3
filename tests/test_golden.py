"""Golden tests on the 14-row customer sample (exact rows, member order,
check statuses and error rates, governance row counts)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import audit, gold, lineage, registry
from strata.plans.flows import run_governed, run_medallion

# The reference's sample customer file (14 data rows: one
# repeated id and one blank id).
SAMPLE_CSV = """id,name,email,region,status
1,John Doe,john@example.com,North,active
2,Jane Smith,jane@example.com,South,active
3,Bob Johnson,bob@example.com,East,inactive
4,Alice Williams,alice@example.com,West,active
5,Charlie Brown,charlie@example.com,North,active
6,Diana Prince,diana@example.com,South,active
7,Eve Davis,eve@example.com,East,active
8,Frank Miller,frank@example.com,West,inactive
9,Grace Lee,grace@example.com,North,active
10,Henry Wilson,henry@example.com,South,active
1,John Doe,john@example.com,North,active
11,Iris Taylor,iris@example.com,East,active
,Invalid Record,no-id@example.com,West,active
12,Jack Brown,jack@example.com,North,active
"""

# Expected gold members per region, in file order.
EXPECTED_MEMBERS = {"North": ["1", "5", "9", "12"], "South": ["2", "6", "10"],
                    "East": ["3", "7", "11"], "West": ["4", "8"]}
AS_OF = dt.datetime(2024, 1, 31)


@pytest.fixture()
def sample(tmp):
    p = os.path.join(tmp, "sample_customers.csv")
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    return p


def test_medallion_layers(spark, sample, tmp):
    res = run_medallion(spark, sample, "customers", "region", os.path.join(tmp, "lake"), fmt="json",
                        as_of=AS_OF)
    assert res.counts == {"bronze": 14, "silver": 12, "gold": 4}
    g = {r["region"]: r["count"] for r in spark.read.json(res.paths["gold"]).collect()}
    assert g == {"North": 4, "South": 3, "East": 3, "West": 2}
    m = spark.read.schema(res.schemas["silver"]).json(res.paths["silver"])
    arr = {r["region"]: r["records"] for r in gold.members_array(m, "region", "id").collect()}
    assert arr == EXPECTED_MEMBERS
    # the first copy of id 1 won, and every silver id is unique and non-blank
    silver = spark.read.schema(res.schemas["silver"]).json(res.paths["silver"])
    assert silver.select("id").distinct().count() == 12
    assert silver.filter(F.trim("id") == "").count() == 0
    bronze = spark.read.json(res.paths["bronze"])
    assert bronze.filter(F.col("_source_file") == sample).count() == 14
    # reconciliation invariants
    members = spark.read.json(res.paths["gold_members"])
    s_ids = sorted(r["id"] for r in silver.select("id").collect())
    m_ids = sorted(r["id"] for r in members.select("id").collect())
    assert s_ids == m_ids


def test_members_array_refuses_large_groups(spark, sample, tmp):
    res = run_medallion(spark, sample, "c", "region", os.path.join(tmp, "lake"), fmt="json", as_of=AS_OF)
    silver = spark.read.schema(res.schemas["silver"]).json(res.paths["silver"])
    with pytest.raises(ValueError):
        gold.members_array(silver, "region", "id", max_members=3)


def test_governed_run(spark, sample, tmp):
    gov = os.path.join(tmp, "gov")
    res = run_governed(spark, sample, "customers", "region", os.path.join(tmp, "lake"), gov, as_of=AS_OF)
    checks = {c["check_name"]: c for c in res.checks}
    c1, c2 = checks["id_completeness"], checks["deduplication"]
    assert (c1["status"], c1["passed_count"], c1["failed_count"]) == ("warning", 13, 1)
    assert c1["error_rate"] == round(1 / 14, 6)
    assert (c2["status"], c2["passed_count"], c2["failed_count"]) == ("passed", 12, 1)
    assert c2["error_rate"] == round(1 / 13, 6)

    cur = registry.current_tables(registry.registry_tables(spark, gov))
    summary = {r["layer"]: (r["table_count"], r["total_records"])
               for r in registry.governance_summary(cur).collect()}
    assert summary["_total"] == (3, 30)
    edges = spark.read.parquet(f"{gov}/lineage")
    assert edges.count() == 2
    up = lineage.walk(edges, "lakehouse.gold.customers_by_region", "upstream").collect()
    assert [(r["source_table"], r["depth"]) for r in sorted(up, key=lambda r: r["depth"])] == [
        ("lakehouse.silver.customers", 0), ("lakehouse.bronze.customers", 1)]
    flows = {(r["source_table"].split(".")[1], r["records_read"], r["records_written"])
             for r in spark.read.parquet(f"{gov}/data_flows").collect()}
    assert flows == {("external", 14, 14), ("bronze", 14, 12), ("silver", 12, 4)}
    assert spark.read.parquet(f"{gov}/data_access_log").count() == 6
    assert spark.read.parquet(f"{gov}/audit_log").count() == 7
    runs = lineage.current_runs(spark.read.parquet(f"{gov}/run_events")).collect()
    assert [(r["run_id"], r["status"]) for r in runs] == [(1, "success")]
    cols = registry.table_info(cur, registry.registry_columns(spark, gov)).filter(
        F.col("full_name") == "lakehouse.gold.customers_by_region").first()["columns"]
    assert [c["column_name"] for c in cols] == ["region", "count", "_aggregation_timestamp"]


def test_governed_rerun_fails_before_writing(spark, sample, tmp):
    gov, lake = os.path.join(tmp, "gov"), os.path.join(tmp, "lake")
    run_governed(spark, sample, "customers", "region", lake, gov, as_of=AS_OF)
    before = os.path.getmtime(os.path.join(lake, "bronze", "customers"))
    with pytest.raises(ValueError, match="already registered"):
        run_governed(spark, sample, "customers", "region", lake, gov, as_of=AS_OF)
    assert os.path.getmtime(os.path.join(lake, "bronze", "customers")) == before
    # no second run was started
    assert spark.read.parquet(f"{gov}/run_events").select("run_id").distinct().count() == 1


def test_failed_run_is_recorded(spark, tmp):
    gov = os.path.join(tmp, "gov")
    with pytest.raises(Exception):
        run_governed(spark, os.path.join(tmp, "missing.csv"), "x", "region", os.path.join(tmp, "lake"), gov,
                     as_of=AS_OF)
    runs = lineage.current_runs(spark.read.parquet(f"{gov}/run_events")).collect()
    assert runs[0]["status"] == "failed" and runs[0]["error_message"]
    trail = audit.audit_trail(spark.read.parquet(f"{gov}/audit_log"))
    assert {r["status"] for r in trail.collect()} == {"success", "failed"}


def test_log_readers_read_a_governed_run(spark, sample, tmp):
    gov = os.path.join(tmp, "gov")
    res = run_governed(spark, sample, "customers", "region", os.path.join(tmp, "lake"), gov, as_of=AS_OF)
    logs = {k: spark.read.parquet(f"{gov}/{k}") for k in ("audit_log", "data_access_log", "quality_log")}
    trail = audit.audit_trail(logs["audit_log"]).collect()
    assert trail[0]["action"] == "complete_pipeline" and trail[-1]["action"] == "start_pipeline"
    assert {"ip_address", "session_id"} <= set(logs["audit_log"].columns)
    assert audit.access_history(logs["data_access_log"]).count() == 6
    assert audit.quality_history(logs["quality_log"]).count() == 2
    for k, c in (("audit_log", "audit_id"), ("data_access_log", "access_id"), ("quality_log", "quality_id")):
        assert logs[k].select(c).distinct().count() == logs[k].count()
    flows = {r["target_table"].split(".")[1]: r for r in spark.read.parquet(f"{gov}/data_flows").collect()}
    for layer, seconds in res.seconds.items():
        assert flows[layer]["duration_seconds"] == seconds > 0
        assert flows[layer]["bytes_read"] > 0 and flows[layer]["bytes_written"] > 0


def test_governed_rerun_with_replace_adds_versions(spark, sample, tmp):
    gov, lake = os.path.join(tmp, "gov"), os.path.join(tmp, "lake")
    run_governed(spark, sample, "customers", "region", lake, gov, as_of=AS_OF)
    res = run_governed(spark, sample, "customers", "region", lake, gov, if_exists="replace", as_of=AS_OF)
    assert res.run_id == 2
    cur = registry.current_tables(registry.registry_tables(spark, gov))
    assert {r["version"] for r in cur.collect()} == {2}
    assert {r["layer"]: r["total_records"] for r in registry.governance_summary(cur).collect()}["_total"] == 30


def test_access_log_writers_share_one_schema(spark, sample, tmp):
    gov = os.path.join(tmp, "gov")
    run_governed(spark, sample, "customers", "region", os.path.join(tmp, "lake"), gov, as_of=AS_OF)
    audit.log_access(spark, gov, [(dt.datetime(2024, 1, 31), "ann", "lakehouse.gold.customers_by_region",
                                   "read", 4, "select *", "success", 12, None)])
    log = spark.read.schema(audit.ACCESS_SCHEMA).parquet(f"{gov}/data_access_log")
    assert log.count() == 7
    assert log.filter(F.col("details").contains("run_id")).count() == 6
