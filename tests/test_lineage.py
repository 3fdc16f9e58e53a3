"""Lineage over bucketed edges: reach, hubs, and no exchange of the edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import lineage
from strata.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
TS = dt.datetime(2024, 1, 1)


def edges(spark, pairs):
    return spark.createDataFrame([(s, t, "x", "p", TS, None) for s, t in pairs], lineage.EDGE_SCHEMA)


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_impact_reaches_the_end_of_a_long_chain(spark):
    e = edges(spark, [(f"t{i}", f"t{i + 1}") for i in range(20)])
    got = {r["affected_table"]: r["distance"] for r in lineage.impact(e, "t0").collect()}
    assert got == {f"t{i}": i for i in range(1, 21)}
    assert lineage.impact(e, "t0", max_depth=10).count() == 11   # the listing's bound, where it is asked for
    assert lineage.impact(e, "nowhere").count() == 0


def test_only_nodes_move_from_the_second_level_on(spark, no_broadcast):
    store = lineage.store_edges(fx.lineage_edges(spark, SF), ["upstream"])
    frontier = spark.range(50).select(F.concat(F.lit("lakehouse.bronze.t"), "id").alias("node"))
    for s, exchanges in ((store, 1), (lineage.store_edges(fx.lineage_edges(spark, SF), ["upstream"], hub_edges=2), None)):
        text = s.meet(frontier, "upstream")._jdf.queryExecution().executedPlan().toString()
        edge_side = text[text.index("SortMergeJoin [_near"):text.index("+- Sort [node")]
        assert "strata_edges" in edge_side and "Bucketed: true" in edge_side and "Exchange" not in edge_side, text
        assert exchanges is None or text.count("Exchange") == exchanges        # the frontier's


def test_a_hub_is_spread_over_parts(spark, no_broadcast):
    pairs = [("hub", f"d{i}") for i in range(900)] + [(f"s{i}", "hub") for i in range(700)] + [("d1", "z")]
    pairs += [("hub", "d0")] * 3                              # parallel edges all count
    e = edges(spark, pairs)
    store = lineage.store_edges(e, hub_edges=50)
    for direction, n in (("downstream", 903), ("upstream", 700)):
        rows = store.edges[direction].where(F.col("_near") == "hub").groupBy("_part").count().collect()
        assert sum(r["count"] for r in rows) == n
        assert len(rows) > 0.8 * n / 50 and max(r["count"] for r in rows) <= 100
    plain = lineage.lineage_graph(e, "hub")
    salted = lineage.lineage_graph(store, "hub")
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))
    assert salted.count() == 903 + 700 + 1


def test_walks_share_a_store_and_take_a_table_of_starts(spark):
    e = fx.lineage_edges(spark, SF)
    store = lineage.store_edges(e)
    starts = ["lakehouse.silver.t7", "lakehouse.bronze.t3"]
    one = lineage.walk(store, starts, "downstream")
    two = lineage.walk(e, spark.createDataFrame([(s,) for s in starts], "t string"), "downstream")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) != []
    before = set(spark.catalog.listTables())
    lineage.walk(store, starts, "upstream").collect()
    assert set(spark.catalog.listTables()) == before          # no names are left behind


def test_nulls_and_self_edges(spark):
    e = edges(spark, [("a", None), (None, "a"), ("a", "a"), ("a", "b"), ("b", "a")])
    got = sorted((str(r["source_table"]), str(r["target_table"]), r["depth"]) for r in lineage.walk(e, "a", "downstream").collect())
    assert got == [("a", "None", 0), ("a", "a", 0), ("a", "b", 0), ("b", "a", 1)]
