"""Paths chosen by size give one answer, and row types without an order are kept."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import registry, silver
from strata.operators.sequence import next_in_sequence, previous_in_sequence
from strata.sinks.writers import write

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Null keys, null times, bursts and ties broken by id."""
    data = []
    for i in range(400):
        key = None if i % 7 == 0 else f"k{i % 3}"
        ts = None if i % 11 == 0 else T0 + dt.timedelta(seconds=(i * 37) % 50 if i % 2 else i * 5000)
        data.append((i, key, ts, None if i % 13 == 0 else i * 10))
    return spark.createDataFrame(data, "id long, k string, ts timestamp_ntz, v long")


@pytest.mark.parametrize("fn", [next_in_sequence, previous_in_sequence])
@pytest.mark.parametrize("value", ["v", "ts"])
def test_every_sequence_path_agrees(rows, fn, value):
    def run(**how):
        return sorted((r["id"], str(r["o"])) for r in
                      fn(rows, ["k"], "ts", ["id"], value=value, out_col="o", **how).collect())
    plain = run(bucket=None)
    assert run(hot_rows=1) == plain
    assert run(hot_rows=60) == plain
    for unit in ("day", "hour", "second"):
        assert run(bucket=unit, hot_rows=None) == plain


def test_dedup_keeps_map_columns(spark):
    df = spark.createDataFrame([(1, 1, {"a": "x"}, "p"), (1, 2, {"a": "y"}, "q"), (2, 1, None, "r")],
                               "k int, o int, m map<string,string>, s string")
    assert {r["k"]: r["m"] for r in silver.keep_first(df, "k", "o").collect()} == {1: {"a": "x"}, 2: None}
    assert {r["k"]: r["s"] for r in silver.keep_latest(df, "k", ["o"]).collect()} == {1: "q", 2: "r"}
    assert {r["k"]: r["_copies"] for r in silver.keep_first_with_count(df, "k", "o").collect()} == {1: 2, 2: 1}


def test_schema_diff_over_a_version_gap(spark):
    cols = spark.createDataFrame([("t", 1, "a", "int"), ("t", 3, "a", "long"), ("t", 3, "b", "int"), ("u", 2, "a", "int")],
                                 "full_name string, version int, column_name string, data_type string")
    got = {(r["full_name"], r["column_name"], r["change"]) for r in registry.schema_diff(cols).collect()}
    assert got == {("t", "a", "retyped"), ("t", "b", "added")}


def test_export_and_restore_keep_every_field(spark, tmp):
    ts = dt.datetime(2024, 1, 31, 12, 0, 0, 123456)
    registry.register_table(spark, tmp, "silver", "t", description="d", owner="o", properties={"x": "1"},
                            columns=[{"column_name": "a"}], row_count=3, size_bytes=9, as_of=ts)
    cur = registry.current_tables(registry.registry_tables(spark, tmp))
    path = os.path.join(tmp, "export")
    registry.export_catalog(cur, registry.registry_columns(spark, tmp), path)
    tables, cols = registry.restore_catalog(spark, path)
    want = cur.first().asDict()
    got = tables.first().asDict()
    assert {k: got[k] for k in want} == want and got["updated_at"] == ts
    assert cols.select("column_name").first()[0] == "a"


def test_a_hot_partition_is_split_on_write(spark, tmp):
    path = os.path.join(tmp, "hot")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(0, 400_000, 1, 8).select("id", F.uuid().alias("u"),
                                                  F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("p"))
        assert write(df, path, partition_by=["p"]) == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for f in os.listdir(os.path.join(path, "p=hot")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 400_000
