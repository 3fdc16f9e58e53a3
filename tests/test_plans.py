"""Physical-plan shape: the scale properties the operators rely on."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_combines_before_the_shuffle(spark):
    p = plan(E.queries()["silver_keep_first"](spark, SF))
    # partial min over the row struct happens below (before) the exchange on the key
    assert re.search(r"partial_min\(", p)
    assert p.index("Exchange hashpartitioning(id") < p.index("partial_min(")


def test_top_k_per_pipeline_limits_before_the_shuffle(spark):
    p = plan(E.queries()["run_history"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2      # partial (map side) + final


def test_null_profile_is_one_pass(spark):
    p = plan(E.queries()["null_profile"](spark, SF))
    assert p.count("Scan parquet") == 2          # the two arms of the messy fixture, nothing more
    assert "Expand" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(E.queries()["star_enriched_sales"](spark, SF))
    li = re.search(r"ReadSchema: (struct<l_[^>]*>)", p).group(1)
    assert "l_shipdate" not in li and "l_comment" not in li and "l_returnflag" not in li


def test_only_fixed_size_dimensions_are_hinted_for_broadcast(spark):
    from strata.operators import gold
    from strata.sources.tables import table
    t = lambda n: table(spark, SF, n)
    df = gold.enrich_sales(t("lineitem"), t("orders"), t("customer"), t("nation"), t("region"))
    hints = df._jdf.queryExecution().logical().toString()
    assert hints.count("broadcast") == 2         # nation and region only


def test_governance_summary_aggregates_before_joining_layers(spark):
    p = plan(E.queries()["governance_summary"](spark, SF))
    # the registry is reduced per layer before the 3-row layer list joins it
    agg_pos = p.find("partial_count")
    assert agg_pos != -1


def test_checks_of_a_table_share_one_scan(spark):
    p = plan(E.queries()["quality_results"](spark, SF))
    # two tables of two arms each, whatever the number of checks
    from strata.plans import fixtures as fx
    once = sum(plan(f(spark, SF)).count("Scan parquet") for f in (fx.messy_orders, fx.messy_contacts))
    assert p.count("Scan parquet") == once


def test_access_summary_reads_the_log_once(spark):
    from strata.plans import fixtures as fx
    p = plan(E.queries()["access_summary"](spark, SF))
    assert p.count("Scan parquet") == plan(fx.access_log(spark, SF)).count("Scan parquet")
    assert "Join" not in p
