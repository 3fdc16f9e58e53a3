"""The derived fixtures reproduce the figures probed for them at sf0.01."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.operators import lineage
from strata.plans import fixtures as fx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_f1_messy_orders(spark, q):
    b = fx.messy_orders(spark, SF)
    assert (b.count(), b.filter("id is not null").count()) == (17143, 15584)
    assert q["silver_keep_first"](spark, SF).count() == 12587
    groups = {r["prio"]: r["count"] for r in q["medallion_gold"](spark, SF).collect()}
    assert [groups[k] for k in sorted(groups)] == [2508, 2507, 2502, 2541, 2529]


def test_f2_messy_contacts(spark):
    c = fx.messy_contacts(spark, SF)
    n = lambda cond: c.filter(cond).count()
    assert n("email is null or email = ''") == 300
    assert n(~F.col("email").like("%@%")) == 300
    assert n("phone is null or length(regexp_replace(phone, '[^0-9]', '')) < 10") == 334
    assert n(~F.coalesce(F.col("status").isin("active", "inactive", "suspended"), F.lit(False))) == 600
    assert n(~F.col("source_system").isin("crm", "erp", "website")) == 375


def test_f3_runs_and_flows(spark, q):
    runs = {r["status"]: r["count"] for r in fx.pipeline_runs(spark, SF).groupBy("status").count().collect()}
    assert sorted(runs.values()) == sorted([4933, 5088, 4979])
    assert q["orphan_check"](spark, SF).count() == 646
    assert fx.data_flows(spark, SF).filter("records_read = 0").count() == 1217


def test_f4_registry_summary(spark, q):
    s = {r["layer"]: (r["table_count"], r["total_records"]) for r in q["governance_summary"](spark, SF).collect()}
    assert s["bronze"] == (667, 1799700) and s["silver"] == (667, 1762100) and s["gold"] == (666, 1882050)


def test_f5_lineage(spark, q):
    up = q["lineage_upstream"](spark, SF)
    assert up.count() == 1145 and up.agg(F.max("depth")).first()[0] == 6
    # The probe stopped at depth 2; the graph now goes on to depth 10.
    g = lineage.lineage_graph(fx.lineage_edges(spark, SF), "lakehouse.silver.t7", max_depth=2)
    assert g.filter("direction = 'upstream'").count() == 63
    deep = q["lineage_graph"](spark, SF).filter("direction = 'upstream'")
    assert deep.filter("depth <= 2").count() == 63 and deep.count() == 786


def test_f6_access_summary_t3(spark, q):
    rows = {r["access_type"]: (r["count"], r["total_rows"], r["type_users"])
            for r in q["access_summary"](spark, SF).filter("table_name = 'lakehouse.silver.t3'").collect()}
    assert rows == {"insert": (107, 5284, 69), "read": (200, 10943, 110), "scan": (107, 5459, 77),
                    "write": (86, 3818, 60)}


def test_alert_probe(spark, q):
    assert q["error_rate_alert"](spark, SF).count() == 13
