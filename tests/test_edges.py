"""Edge fixtures: CSV defects, blank keys, cycles, parallel edges, zero
counts, versioned overwrite, gates, and the skew-safe sequence helper."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.scalar import file_stem, not_blank, seconds_to_ms
from strata.operators import incremental, lineage, monitoring, quality, silver
from strata.operators.sequence import next_in_sequence, previous_in_sequence
from strata.sinks.writers import committed_versions, read_current, write_version
from strata.sources.files import read_csv_strings

EDGE_CSV = ('id,name,region\n'
            '1,plain,North\n'
            '2,short\n'
            '3,long,East,extra\n'
            '\n'
            ',blank id,West\n'
            '\t,tab id,West\n'
            '4,"comma, inside",South\n'
            '5,"doubled ""quotes""",South\n'
            '6,,\n'
            ' 1,spaced copy,North\n')


def test_csv_edge_file(spark, tmp):
    p = os.path.join(tmp, "edge.csv")
    with open(p, "w") as f:
        f.write(EDGE_CSV)
    df = read_csv_strings(spark, p)
    rows = {r["name"]: r for r in df.collect()}
    assert rows["short"]["region"] is None          # missing field stays null
    assert rows["long"]["region"] == "East"         # long row keeps declared fields
    assert rows["comma, inside"]["region"] == "South"
    assert rows['doubled "quotes"']["id"] == "5"
    assert rows[""]["region"] == ""                 # empty field is '' not null (row 6)
    assert len(df.collect()) == 9                   # blank line skipped
    kept = silver.require_keys(df, "id")
    assert sorted(r["id"] for r in kept.collect()) == [" 1", "1", "2", "3", "4", "5", "6"]
    first = silver.keep_first(kept, "id")
    assert first.count() == 7                       # ' 1' and '1' are different keys
    # file order survives through the ordinal
    ords = [r["_ord"]["row"] for r in df.orderBy("_ord").collect()]
    assert ords == sorted(ords)


def test_not_blank_unicode(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("\t",), ("  ",), (None,), (" x ",)], "v string")
    assert [r["v"] for r in df.filter(not_blank("v")).collect()] == ["a", " x "]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("/a/b/x.csv", 0.0), ("y", 1.2345), ("/c/z.tar.gz", None)], "p string, d double")
    out = df.select(file_stem("p").alias("s"), seconds_to_ms("d").alias("ms")).collect()
    assert [(r["s"], r["ms"]) for r in out] == [("x", None), ("y", 1234), ("z.tar", None)]


def test_keep_latest_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "z"), (2, 1, "q")], "k int, ts int, v string")
    out = {r["k"]: r["v"] for r in silver.keep_latest(df, "k", ["ts"]).collect()}
    assert out == {1: "b", 2: "q"}


def _edges(spark, rows):
    ts = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(s, t, k, "p", ts + dt.timedelta(seconds=i), None)
                                  for i, (s, t, k) in enumerate(rows)], lineage.EDGE_SCHEMA)


def test_lineage_cycle_and_parallel_edges(spark):
    e = _edges(spark, [("a", "b", "x"), ("b", "c", "x"), ("c", "a", "x"), ("a", "b", "y")])
    down = lineage.walk(e, "a", "downstream").collect()
    got = sorted((r["source_table"], r["target_table"], r["transformation_type"], r["depth"]) for r in down)
    assert got == [("a", "b", "x", 0), ("a", "b", "y", 0), ("b", "c", "x", 1), ("c", "a", "x", 2)]
    up = lineage.walk(e, "a", "upstream", max_depth=0).collect()
    assert [(r["source_table"], r["depth"]) for r in up] == [("c", 0)]
    capped = lineage.walk(e, "a", "downstream", limit=2).collect()
    assert [r["depth"] for r in capped] == [0, 0]
    imp = {r["affected_table"]: r["distance"] for r in lineage.impact(e, "a").collect()}
    assert imp == {"b": 1, "c": 2, "a": 3}


def test_flow_access_rows_zero_counts(spark):
    flows = spark.createDataFrame([(1, "s", "t", 0, 5, None, None, 0.0, dt.datetime(2024, 1, 1)),
                                   (2, "s", "t", 3, 0, None, None, 1.5, dt.datetime(2024, 1, 1))],
                                  lineage.FLOW_SCHEMA)
    rows = sorted((r["run_id"], r["access_type"], r["rows_affected"], r["duration_ms"])
                  for r in lineage.flow_access_rows(flows).collect())
    assert rows == [(1, "write", 5, None), (2, "read", 3, 1500)]


def test_versioned_overwrite(spark, tmp):
    base = os.path.join(tmp, "t")
    write_version(spark.range(3), base)
    write_version(spark.range(5), base)
    assert committed_versions(spark, base) == [1, 2]
    os.makedirs(os.path.join(base, "v=00000003"))      # a failed attempt: no _SUCCESS
    assert read_current(spark, base).count() == 5
    p, n = write_version(spark.range(7), base)
    assert p.endswith("v=00000004") and n == 7


def test_merge_and_cdc(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, v string, price double")
    upd = spark.createDataFrame([(2, "B", "web"), (3, "c", "web")], "k int, v string, channel string")
    out = sorted(tuple(r) for r in incremental.merge_upsert(tgt, upd, "k").collect())
    assert out == [(1, "a", None), (2, "B", "web"), (3, "c", "web")]
    ch = spark.createDataFrame([(1, 1, "I", "x"), (1, 2, "D", "x"), (2, 1, "I", "y"), (2, 3, "U", "z")],
                               "k int, seq int, op string, v string")
    got = sorted((r["k"], r["v"]) for r in incremental.cdc_apply(None, ch, "k").collect())
    assert got == [(2, "z")]


def test_incremental_empty_target_takes_all(spark):
    src = spark.createDataFrame([(1, 10), (2, 20)], "k int, ts int")
    tgt = spark.createDataFrame([], "k int, ts int")
    assert incremental.incremental_model(src, tgt, "k", "ts").count() == 2


def test_gates(spark):
    ok = spark.createDataFrame([(0.9,)], "retention double")
    assert quality.enforce(quality.score_gate(ok))["passed"]
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.score_gate(spark.createDataFrame([(0.5,)], "retention double")))


@pytest.mark.parametrize("bucket,hot_rows", [("hour", None), ("day", None), ("day", 200), (None, None)])
def test_sequence_helpers_match_window(spark, bucket, hot_rows):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice([0, 0, 0, 1, 2]), base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5)), i,
             rnd.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int, v int")
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = df.select("id", F.lead("ts").over(w).alias("n"), F.lag("v").over(w).alias("p"))
    # hot_rows=200: key 0 (~60 % of rows) is split into ranges, keys 1-2 are not
    got = next_in_sequence(df, ["k"], "ts", ["id"], out_col="n", bucket=bucket, hot_rows=hot_rows)
    got = previous_in_sequence(got, ["k"], "ts", ["id"], value="v", out_col="p", bucket=bucket,
                               hot_rows=hot_rows)
    assert sorted(tuple(r) for r in ref.collect()) == sorted(tuple(r) for r in got.select("id", "n", "p").collect())


def test_sustained_islands(spark):
    base = dt.datetime(2024, 1, 1)
    hours = [0, 1, 2, 4, 5, 6, 7, 9]
    df = spark.createDataFrame([("e", base + dt.timedelta(hours=h), 5) for h in hours],
                               "label string, bucket timestamp_ntz, amount int")
    isl = monitoring.sustained(df, ["label"], F.col("amount") >= 4, 3600, 3).orderBy("start").collect()
    assert [(r["buckets"], r["amount"]) for r in isl] == [(3, 15), (4, 20)]


def test_lineage_large_frontier_path(spark):
    rows = [(f"t{n}", f"t{n // 3}", "derive") for n in range(1, 400)]
    rows += [(f"t{n}", f"t{n // 2}", "join") for n in range(5, 400, 5)]
    e = _edges(spark, rows)
    a = sorted(tuple(r) for r in lineage.walk(e, "t1", "upstream", max_depth=4).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # shuffle joins on every level
    try:
        b = sorted(tuple(r) for r in lineage.walk(e, "t1", "upstream", max_depth=4).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b and len(a) > 100


def test_missing_group_is_unknown_and_empty_group_stays(spark, tmp):
    from strata.operators import gold
    p = os.path.join(tmp, "g.csv")
    with open(p, "w") as f:
        f.write(EDGE_CSV)
    df = silver.keep_first(silver.require_keys(read_csv_strings(spark, p), "id"), "id")
    groups = {r["region"]: r["count"] for r in gold.group_count(df, "region").collect()}
    assert groups["unknown"] == 1          # short row: field absent
    assert groups[""] == 1                 # row 6: field present but empty


def test_empty_input(spark):
    from strata.operators import gold
    empty = spark.createDataFrame([], "id string, region string")
    r = quality.retention_report(empty, "id").first()
    assert (r["bronze_rows"], r["silver_rows"], r["retention"]) == (0, 0, 0.0)
    assert gold.group_count(empty, "region").count() == 0
    assert silver.keep_first(empty.withColumn("_ord", F.lit(1)), "id").count() == 0


def test_merge_and_incremental_are_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, ts int")
    upd = spark.createDataFrame([(2, "B", 30), (3, "c", 31)], "k int, v string, ts int")
    once = incremental.merge_upsert(tgt, upd, "k")
    twice = incremental.merge_upsert(once, upd, "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # incremental model: re-running with the same source adds nothing new
    src = tgt.unionByName(upd)
    first = incremental.incremental_model(src, None, "k", "ts")
    again = incremental.incremental_model(src, first, "k", "ts")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    # watermark state: the second batch after advancing is empty
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                               "id int, ts timestamp_ntz")
    st = incremental.next_state(incremental.new_rows(ev, "ts", "2023-12-31 00:00:00"), "ev", "ts",
                                "2023-12-31 00:00:00")
    assert incremental.new_rows(ev, "ts", incremental.watermark_of(st, "ev")).count() == 0


def test_a_hot_day_is_split(spark):
    from strata.operators.sequence import ranges_of, with_range
    base = dt.datetime(2024, 1, 1)
    rows = [(0, base + dt.timedelta(minutes=i % 300), i) for i in range(900)]      # a burst inside one day
    rows += [(0, base + dt.timedelta(days=d), 10_000 + d) for d in range(1, 5)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int")
    ref = df.withColumn("n", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    got = next_in_sequence(df, ["k"], "ts", ["id"], out_col="n", hot_rows=100)
    assert sorted(map(tuple, ref.collect())) == sorted(map(tuple, got.select(*ref.columns).collect()))
    parts = with_range(df, ranges_of(df, ["k"], "ts", ["id"], 100)).groupBy("_range").count().collect()
    assert len(parts) >= 9 and max(r["count"] for r in parts) <= 200
