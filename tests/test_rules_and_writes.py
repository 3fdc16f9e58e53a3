"""Alert rules at their windows, quantile sketches, ordered changes, fingerprints of
writes, expiry by partition, and the registry's remaining fields."""

import datetime as dt
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.scalar import json_fields, json_text
from strata.operators import audit, incremental, monitoring as mon, quality, registry
from strata.plans import flows
from strata.sinks.writers import (expire_partitions, fingerprint_columns, read_current, write, write_fingerprinted,
                                  write_json, write_version)
from strata.sources.files import read_json, read_table

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- D8

def test_older_changes_lose_and_deleted_keys_stay_deleted(spark):
    schema = "k int, seq int, v string, op string"
    target = spark.createDataFrame([(1, 9, "new", "I"), (2, 1, "old", "I"), (3, 1, "x", "I")], schema)
    state = incremental.cdc_merge(target, spark.createDataFrame(
        [(1, 3, "older", "U"), (2, 5, "newer", "U"), (3, 4, None, "D"), (4, 2, None, "D")], schema), "k")
    state = incremental.cdc_merge(state, spark.createDataFrame(
        [(3, 2, "from before the delete", "U"), (4, 1, "too", "I"), (5, 1, "fresh", "I")], schema), "k")
    rows = sorted(map(tuple, incremental.cdc_rows(state).select("k", "seq", "v").collect()))
    assert rows == [(1, 9, "new"), (2, 5, "newer"), (5, 1, "fresh")]
    again = incremental.cdc_merge(state, spark.createDataFrame([(3, 4, None, "D")], schema), "k")
    assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))
    kept = incremental.cdc_compact(state, 4)
    assert sorted(r["k"] for r in kept.collect()) == [1, 2, 3, 5]         # the tombstone of 4 is old enough to go


def test_changes_on_a_plain_table_and_equal_orders(spark):
    plain = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ch = spark.createDataFrame([(1, 5, "n", "U"), (2, 5, None, "D"), (3, None, "z", None)], "k int, seq int, v string, op string")
    got = sorted((r["k"], r["v"]) for r in incremental.cdc_apply(plain, ch, "k").collect())
    assert got == [(1, "n"), (3, "z")]
    target = spark.createDataFrame([(1, 5, "zz", "I")], "k int, seq int, v string, op string")
    assert incremental.cdc_apply(target, ch, "k").filter("k = 1").first()["v"] == "n"   # the incoming one at equal order


# ---- R1, R4, R5

@SETTINGS
@given(samples=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1500), st.integers(0, 60)), min_size=1, max_size=40,
                        unique_by=lambda t: (t[0], t[1])), per_range=st.sampled_from([5, 10_000]))
def test_sliding_rate_is_that_of_the_samples(spark, samples, per_range):
    rows = [(f"c{c}", T0 + dt.timedelta(seconds=s), v, i) for i, (c, s, v) in enumerate(samples)]
    df = spark.createDataFrame(rows, "c string, ts timestamp_ntz, v long, id int")
    got = {(r["c"], r["bucket"]): r["amount"] for r in
           mon.sliding_rate(df, ["c"], "ts", "v", ["id"], rows_per_range=per_range).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        seq = sorted((r[1], r[2]) for r in rows if r[0] == c)
        inc = [(b[0], b[1] - a[1] if b[1] >= a[1] else b[1]) for a, b in zip(seq, seq[1:])]
        step = lambda t: (t - T0).seconds // 60
        for k in range(step(seq[0][0]), step(seq[-1][0]) + 1):
            want[c, T0 + dt.timedelta(minutes=k)] = sum(v for t, v in inc if k - 4 <= step(t) <= k)
    assert got == want


def test_sketches_rolled_up_stay_within_their_error(spark):
    df = spark.range(120_000).select((F.col("id") % 2).cast("string").alias("layer"),
                                     (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 900)).cast("timestamp_ntz").alias("ts"),
                                     F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"))
    rolled = mon.rolled_quantile(mon.sketch_per_step(df, ["layer"], "ts", "v", k=400), ["layer"], 0.95).collect()
    rows = df.collect()
    assert len(rolled) >= 2 * 15
    for r in rolled[::7]:
        start = r["bucket"] - dt.timedelta(minutes=4)
        inside = sorted(x["v"] for x in rows if x["layer"] == r["layer"] and start <= x["ts"] < r["bucket"] + dt.timedelta(minutes=1))
        assert len(inside) == r["samples"]
        rank = sum(v <= r["p95"] for v in inside) / len(inside)
        assert abs(rank - 0.95) < 0.015
    exact = df.filter(F.col("ts") < F.lit(T0 + dt.timedelta(minutes=1))).groupBy("layer").agg(F.percentile("v", F.lit(0.95)).alias("p"))
    first = {r["layer"]: r["p95"] for r in rolled if r["bucket"] == T0}
    assert all(abs(first[r["layer"]] - r["p"]) < 2_000 for r in exact.collect())


def test_a_rule_holds_before_it_fires(spark):
    rows = [("a", T0 + dt.timedelta(minutes=m), 1 if 3 <= m <= 8 or 20 <= m <= 24 else 0) for m in range(40)]
    grid = spark.createDataFrame(rows, "c string, bucket timestamp_ntz, amount int")
    got = mon.held(grid, ["c"], F.col("amount") > 0, 60, 300).collect()
    assert [(r["start"].minute, r["last"].minute) for r in got] == [(3, 8)]   # 20-24 lasts four minutes only


def test_stale_periods_need_their_hold(spark):
    rows = [("a", T0, 1), ("a", T0 + dt.timedelta(seconds=7200 + 299), 2), ("b", T0, 3),
            ("b", T0 + dt.timedelta(seconds=7200 + 300), 4), ("c", T0, 5)]
    df = spark.createDataFrame(rows, "d string, ts timestamp_ntz, id int")
    got = sorted((r["d"], r["start"], r["end"], r["stale_s"]) for r in
                 mon.stale_periods(df, "d", "ts", ["id"], as_of=T0 + dt.timedelta(hours=4)).collect())
    assert ("b", T0 + dt.timedelta(hours=2), T0 + dt.timedelta(seconds=7500), 300) in got
    assert ("c", T0 + dt.timedelta(hours=2), None, 7200) in got
    assert not any(g[0] == "a" and g[2] is not None for g in got)


# ---- U3, U4, Q10

def test_fingerprints_find_a_lost_a_doubled_and_a_changed_row(spark, tmp):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") * 2).alias("v"),
                                  F.create_map(F.lit("b"), F.col("id"), F.lit("a"), F.lit(1)).alias("m"))
    whole = write_fingerprinted(df, f"{tmp}/a")
    back = spark.read.parquet(f"{tmp}/a")
    put = lambda d, n: write_fingerprinted(d, f"{tmp}/{n}")
    assert put(back.repartition(7), "b") == whole
    assert put(back.filter("id < 400"), "c") + put(back.filter("id >= 400"), "d") == whole
    bad = {"lost": back.filter("id <> 5"), "doubled": back.unionByName(back.filter("id = 5")),
           "changed": back.withColumn("v", F.when(F.col("id") == 5, F.lit(11)).otherwise(F.col("v"))),
           "moved null": back.withColumns({"v": F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("v"))}),
           "swapped": back.withColumn("v", F.when(F.col("id") == 5, F.lit(8)).when(F.col("id") == 4, F.lit(10)).otherwise(F.col("v")))}
    checks = quality.reconcile_writes(spark, [(n, whole, put(d, n.replace(" ", ""))) for n, d in bad.items()])
    assert {r["check_name"]: r["status"] for r in checks.collect()} == {n: "failed" for n in bad}
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "FileScan" not in plan            # no layer is read again


def test_fingerprint_of_nothing_and_of_swapped_nulls(spark, tmp):
    empty = spark.createDataFrame([], "a int, b int")
    assert write_fingerprinted(empty, f"{tmp}/e").rows == 0
    one, two = (spark.createDataFrame([r], "a int, b int").agg(*fingerprint_columns(empty)).first()["digest"]
                for r in ((None, 1), (1, None)))
    assert one != two


# ---- I4, I6

@pytest.mark.parametrize("cutoff", ["2024-01-03 06:00:00", "2024-01-03 00:00:00", "2023-12-01 01:00:00", "2024-02-01 01:00:00"])
def test_expiry_drops_days_and_rewrites_the_boundary_only(spark, tmp, cutoff):
    df = spark.range(480).select("id", (F.lit(T0) + F.make_dt_interval(hours=F.col("id") % 120)).cast("timestamp_ntz").alias("ts"))
    write(df.withColumn("date", F.to_date("ts")), tmp, partition_by=["date"])
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp)
                     for f in fs if "date=" in d and f.endswith(".parquet")}
    before = files()
    gone, left = expire_partitions(spark, tmp, "date", "ts", cutoff)
    rows = df.filter(F.col("ts") >= F.lit(cutoff).cast("timestamp_ntz"))
    days = [p for p in os.listdir(tmp) if p.startswith("date=")]
    if rows.isEmpty():
        assert days == []
        return
    assert sorted(map(str, spark.read.schema(df.schema).parquet(tmp).drop("date").collect())) == sorted(map(str, rows.collect()))
    assert all(d >= f"date={cutoff[:10]}" for d in days)
    later = {f: t for f, t in before.items() if f.split("date=")[1][:10] > cutoff[:10]}
    assert later and {f: t for f, t in files().items() if f in later} == later     # no later day is rewritten
    again = expire_partitions(spark, tmp, "date", "ts", cutoff)
    assert again[0] == [] and again[1] == left


def test_erasure_is_recorded_layer_by_layer(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    write_version(df, f"{tmp}/silver")
    layers = {"silver": (f"{tmp}/silver", "id"), "empty": (f"{tmp}/none", "id"), "broken": (f"{tmp}/silver", "no_such_column")}
    with pytest.raises(Exception):
        incremental.erase_in_layers(spark, layers, spark.createDataFrame([(1,)], "id int"), "id", f"{tmp}/gov")
    log = spark.read.parquet(f"{tmp}/gov/audit_log")
    assert {r["resource_name"]: json.loads(r["details"])["rows_left"] for r in log.collect()} == {"silver": 1, "empty": 0}
    assert [r["id"] for r in read_current(spark, f"{tmp}/silver").collect()] == [2]


# ---- registry, checks, card, files

def test_registry_keeps_creation_time_and_column_descriptions(spark, tmp):
    registry.register_table(spark, tmp, "silver", "t", columns=[{"column_name": "a", "description": "the key"}], as_of=T0)
    registry.update_table_stats(spark, tmp, "silver", "t", row_count=5, as_of=T0 + dt.timedelta(days=2))
    cur = registry.current_tables(registry.registry_tables(spark, tmp))
    row = cur.first()
    assert (row["created_at"], row["updated_at"], row["row_count"]) == (T0, T0 + dt.timedelta(days=2), 5)
    cols = registry.registry_columns(spark, tmp)
    assert registry.table_info(cur, cols).first()["columns"][0]["description"] == "the key"
    n = registry.export_catalog(cur, cols, f"{tmp}/export", gov_root=f"{tmp}/gov", user="u", as_of=T0)
    tables, back = registry.restore_catalog(spark, f"{tmp}/export")
    assert n == 1 and tables.first()["created_at"] == T0 and back.first()["description"] == "the key"
    log = spark.read.parquet(f"{tmp}/gov/audit_log").first()
    assert (log["action"], log["user"], json.loads(log["details"])["tables"]) == ("export_catalog", "u", 1)


def test_check_rows_say_what_they_looked_at(spark):
    df = spark.createDataFrame([("a",), (None,)], "id string")
    checks = [quality.completeness("id"), quality.accepted_values("id", ["a"]), quality.pattern("id")]
    got = {r["check_name"]: json.loads(r["details"]) for r in quality.run_checks(df, "t", checks, details=True).collect()}
    assert got["id_completeness"] == {"column": "id"} and got["id_accepted_values"]["accepted"] == ["a"]
    assert "details" not in quality.run_checks(df, "t", checks).columns


def test_table_report_has_the_size_of_the_files(spark, tmp):
    df = spark.range(200_000).select("id", F.uuid().alias("u"))
    write(df, f"{tmp}/t")
    rows = quality.table_report(spark.read.parquet(f"{tmp}/t"), f"{tmp}/t").collect()
    size = sum(os.path.getsize(f"{tmp}/t/{f}") for f in os.listdir(f"{tmp}/t") if f.endswith(".parquet"))
    assert {r["size_mb"] for r in rows} == {round(size / 1048576, 2)} and len(rows) == 2


def test_json_details_round_trip(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    packed = df.select("a", json_text({"a": F.col("a"), "b": F.col("b")}).alias("j"))
    assert [r["j"] for r in packed.orderBy("a").collect()] == ['{"a":1,"b":"x"}', '{"a":2}']
    back = packed.select(json_fields("j", "a int, b string").alias("s")).select("s.*")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    broken = spark.createDataFrame([("not json",)], "j string").select(json_fields("j", "a int")["a"].alias("a"))
    assert broken.first()["a"] is None


def test_json_and_named_tables_are_read_back(spark, tmp):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string")
    write_json(df, f"{tmp}/j")
    assert sorted(map(tuple, read_json(spark, f"{tmp}/j", schema="a long, b string").collect())) == [(1, None), (2, "b")]
    with open(f"{tmp}/array.json", "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f)
    assert read_json(spark, f"{tmp}/array.json", multiline=True).count() == 2
    write(df, f"{tmp}/p")
    assert read_table(spark, f"{tmp}/p").count() == 2
    df.createOrReplaceTempView("strata_named")
    assert read_table(spark, "strata_named").count() == 2


def test_card_edges_are_the_newest(spark):
    rows = [(f"s{i}", "t", "x", T0 + dt.timedelta(days=i)) for i in range(8)] + [("t", "d", "y", T0)]
    e = spark.createDataFrame(rows, "source_table string, target_table string, transformation_type string, created_at timestamp_ntz")
    got = {r["table_name"]: (r["upstream_tables"], r["downstream_tables"]) for r in audit.card_edges(e, 2).collect()}
    assert got["t"] == ("s7 (x),s6 (x)", "d (y)") and got["s0"] == ("", "t (x)")


def test_a_gated_run_leaves_its_metrics(spark, tmp):
    with open(f"{tmp}/in.csv", "w") as f:
        f.write("id,region\n1,a\n2,b\n2,b\n3,\n")
    res = flows.run_spark_layers(spark, f"{tmp}/in.csv", "crm", "region", f"{tmp}/lake", min_score=0.5)
    assert res.metrics == {"bronze_records": 4.0, "silver_records": 3.0, "gold_records": 3.0, "retention": 0.75}
    assert {r["metric"]: r["value"] for r in spark.read.parquet(f"{tmp}/lake/metrics").collect()} == res.metrics
