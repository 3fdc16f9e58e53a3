"""Compositions M3-M6, registry stats updates, partitioned and dynamic writes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import quality, registry
from strata.plans.flows import run_spark_layers, silver_contacts_model
from strata.sinks.writers import write

CSV = ("id,region,amount\n1,North,10\n2,South,20\n2,South,20\n3,,30\n4,North,\n5,East,50\n")


@pytest.fixture()
def csv(tmp):
    p = os.path.join(tmp, "in.csv")
    with open(p, "w") as f:
        f.write(CSV)
    return p


def test_spark_layers_append_and_overwrite(spark, csv, tmp):
    root = os.path.join(tmp, "lake")
    r1 = run_spark_layers(spark, csv, "crm", "region", root, required=["region"])
    assert r1.counts["bronze"] == 6 and r1.counts["silver"] == 4   # dup + null region removed
    r2 = run_spark_layers(spark, csv, "crm", "region", root, required=["region"])
    assert r2.counts["bronze"] == 12                               # bronze appends
    assert r2.counts["silver"] == 4                                # distinct ignores provenance
    g = {r["region"]: r["count"] for r in spark.read.parquet(r2.paths["gold"]).collect()}
    assert g == {"North": 2, "South": 1, "East": 1}


def test_parquet_layers_drop_any_null_ordered(spark, csv, tmp):
    r = run_spark_layers(spark, csv, "crm", "region", os.path.join(tmp, "m5"), required="any", ordered=True)
    assert r.counts["silver"] == 3


def test_gate_blocks_gold(spark, csv, tmp):
    root = os.path.join(tmp, "m6")
    with pytest.raises(quality.QualityGateError):
        run_spark_layers(spark, csv, "crm", "region", root, required="any", min_score=0.85)
    assert not os.path.exists(os.path.join(root, "gold"))


def test_contacts_model_incremental(spark):
    ts = dt.datetime(2024, 1, 1)
    schema = ("customer_id long, customer_name string, email string, phone string, status string, "
              "source_system string, ingestion_timestamp timestamp_ntz")
    b1 = spark.createDataFrame([(1, "ann", " A@X.io ", "(555) 123-4567", "active", "crm", ts),
                                (1, "ann2", "a@x.io", None, "Closed", "crm", ts + dt.timedelta(hours=1)),
                                (2, None, "b@x.io", "1", "active", "erp", ts)], schema)
    t1 = silver_contacts_model(b1, None)
    rows = {r["customer_id"]: r for r in t1.collect()}
    assert set(rows) == {1}                                  # customer 2 has no name
    assert rows[1]["customer_name"] == "ANN2" and rows[1]["status"] == "unknown"
    assert rows[1]["invalid_phone_flag"] == 1
    b2 = spark.createDataFrame([(3, "cy", "", "555-000-1111", "suspended", "web", ts + dt.timedelta(hours=2)),
                                (1, "old", "o@x.io", None, "active", "crm", ts)], schema)
    t2 = silver_contacts_model(b2, t1.withColumn("ingestion_timestamp", F.col("ingestion_timestamp")))
    got = {r["customer_id"]: r["customer_name"] for r in t2.collect()}
    assert got == {1: "ANN2", 3: "CY"}                       # older replay of 1 is ignored


def test_registry_stats_update(spark, tmp):
    root = os.path.join(tmp, "gov")
    registry.register_table(spark, root, "silver", "t", schema=spark.range(1).schema, row_count=5,
                            as_of=dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        registry.register_table(spark, root, "silver", "t", row_count=6)
    v = registry.update_table_stats(spark, root, "silver", "t", row_count=9, as_of=dt.datetime(2024, 1, 2))
    cur = registry.current_tables(registry.registry_tables(spark, root)).first()
    assert (v, cur["version"], cur["row_count"]) == (2, 2, 9)
    cols = registry.current_columns(registry.current_tables(registry.registry_tables(spark, root)),
                                    registry.registry_columns(spark, root))
    assert [r["column_name"] for r in cols.collect()] == ["id"]


def test_partitioned_and_dynamic_overwrite(spark, tmp):
    path = os.path.join(tmp, "p")
    df = spark.createDataFrame([("N", "2024-01-01", 1), ("S", "2024-01-01", 2), ("N", "2024-01-02", 3)],
                               "region string, date string, v int")
    assert write(df, path, partition_by=["region", "date"]) == 3
    fix = spark.createDataFrame([("N", "2024-01-02", 30)], "region string, date string, v int")
    write(fix, path, partition_by=["region", "date"], dynamic_partitions=True)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("region", F.col("date").cast("string"), "v").collect())
    assert got == [("N", "2024-01-01", 1), ("N", "2024-01-02", 30), ("S", "2024-01-01", 2)]


def test_save_bucketed_table_and_join_without_shuffle(spark, tmp):
    from strata.sinks.writers import save_table
    a = spark.range(1000).withColumn("v", F.col("id") % 7)
    save_table(a, "strata_t_a", bucket_by=(4, ["id"]), path=os.path.join(tmp, "a"))
    save_table(a, "strata_t_b", bucket_by=(4, ["id"]), path=os.path.join(tmp, "b"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = spark.table("strata_t_a").join(spark.table("strata_t_b"), "id")
        assert j.count() == 1000
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p                  # co-located by bucketing
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS strata_t_a")
        spark.sql("DROP TABLE IF EXISTS strata_t_b")


def test_compact_log_partition(spark, tmp):
    from strata.operators import audit
    from strata.sinks.writers import compact_partition
    root = os.path.join(tmp, "gov")
    for i in range(5):
        audit.log_action(spark, root, f"u{i}", "create_table", "table", f"t{i}",
                         as_of=dt.datetime(2024, 1, 2, 10, i))
    audit.log_action(spark, root, "x", "create_table", "table", "other", as_of=dt.datetime(2024, 1, 3))
    part = os.path.join(root, "audit_log", "date=2024-01-02")
    files = lambda: [f for f in os.listdir(part) if f.endswith(".parquet")]
    before = sorted(tuple(r) for r in spark.read.parquet(f"{root}/audit_log").drop("date").collect())
    assert len(files()) == 5
    assert compact_partition(spark, f"{root}/audit_log", "date", "2024-01-02") == 1
    assert len(files()) == 1
    after = sorted(tuple(r) for r in spark.read.parquet(f"{root}/audit_log").drop("date").collect())
    assert before == after                     # same rows, other dates untouched


def test_list_schemas_and_catalogs(spark):
    from strata.plans import fixtures as fx
    cur = registry.current_tables(fx.registry_versions(spark, "/root/testdata/sf0.001"))
    schemas = {r["schema_name"]: r["table_count"] for r in registry.list_schemas(cur).collect()}
    assert set(schemas) == {"bronze", "silver", "gold"} and sum(schemas.values()) == cur.count()
    cats = registry.list_catalogs(cur).collect()
    assert [(r["catalog_name"], r["schema_count"]) for r in cats] == [("lakehouse", 3)]


def test_load_increment_is_repeatable_after_a_failure(spark, tmp):
    from strata.operators import incremental
    root = os.path.join(tmp, "inc")
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(t)] + [(9, None)], "id int, ts timestamp_ntz")

    def load(n):
        return incremental.load_increment(rows.limit(n), "a", "ts", root)

    def ids():
        return sorted(r["id"] for r in incremental.loaded(spark, "a", root, rows.schema).collect())
    assert load(2) == 2
    assert incremental.load_increment(rows.filter("id = 3"), "b", "ts", root) == 1   # tables keep their own state
    state = spark.read.parquet(f"{root}/state")
    before = state.collect()
    # A batch written without its state, as when the driver dies in between, is replaced by the next load.
    rows.filter("id = 2").write.parquet(f"{root}/data/a/after=2024-01-02T000000")
    assert load(5) == 3 and ids() == [0, 1, 2, 3, 4]
    assert load(5) == 0 and ids() == [0, 1, 2, 3, 4]
    assert len(before) == 2


def test_archive_keeps_what_earlier_runs_wrote(spark, tmp):
    from strata.operators import incremental
    path = os.path.join(tmp, "archive")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 8)), (2, dt.datetime(2024, 1, 1, 20)),
                                  (3, dt.datetime(2024, 1, 9))], "id int, ts timestamp_ntz")
    first, second = "2024-01-04 12:00:00", "2024-01-05 12:00:00"
    assert incremental.archive_expired(rows, "ts", 3, path, as_of=first) == 1
    assert incremental.archive_expired(rows, "ts", 3, path, as_of=first) == 1
    left, _ = incremental.retention_split(rows, "ts", 3, first)
    assert incremental.archive_expired(left, "ts", 3, path, as_of=first) == 0    # repeated after the rewrite
    assert incremental.archive_expired(left, "ts", 3, path, as_of=second) == 1   # the rest of the same day
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_erasure_reaches_every_layer_and_is_audited(spark, tmp):
    from strata.operators import incremental
    from strata.sinks.writers import read_current, write_version
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (1, "z"), (None, "w")], "user int, v string")
    layers = {k: (os.path.join(tmp, k), "user") for k in ("bronze", "silver")}
    for p, _ in layers.values():
        write_version(rows, p)
    gone = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    left = incremental.erase_in_layers(spark, layers, gone, "id", os.path.join(tmp, "gov"), user="dpo")
    assert left == {"bronze": 2, "silver": 2}   # a row without a subject stays
    for p, _ in layers.values():
        assert sorted(r["v"] for r in read_current(spark, p).collect()) == ["w", "y"]
    audit = spark.read.parquet(os.path.join(tmp, "gov", "audit_log")).collect()
    assert {(r["resource_name"], r["action"], r["user"]) for r in audit} == {
        ("bronze", "erase_subjects", "dpo"), ("silver", "erase_subjects", "dpo")}
