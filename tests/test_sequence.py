"""Previous / next row by ranges and a carry: one answer, and no task over its share."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import monitoring
from strata.operators.sequence import next_in_sequence, previous_in_sequence, ranges_of, with_range

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp_ntz, v long"


def by_window(df, value, shift):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return sorted(map(str, df.withColumn("o", shift(value, 1).over(w)).collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([None, "a", "a", "a", "b"]), st.sampled_from([None, 0, 0, 1, 5, 9]),
                               st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=60),
       per_range=st.integers(1, 20), value=st.sampled_from(["v", "ts"]))
def test_ranges_and_carry_are_the_window(spark, rows, per_range, value):
    df = spark.createDataFrame([(i, k, None if t is None else T0 + dt.timedelta(seconds=t), v)
                                for i, (k, t, v) in enumerate(rows)], SCHEMA)
    for fn, shift in ((next_in_sequence, F.lead), (previous_in_sequence, F.lag)):
        got = fn(df, ["k"], "ts", ["id"], value=value, out_col="o", hot_rows=per_range)
        assert sorted(map(str, got.collect())) == by_window(df, value, shift)


@pytest.fixture(scope="module")
def burst(spark):
    """90 % of the rows on one key within one second."""
    rnd = random.Random(3)
    rows = [(i, "hot", T0, i % 7) if i % 10 else (i, f"k{i % 30}", T0 + dt.timedelta(seconds=rnd.randrange(9000)), 1)
            for i in range(20_000)]
    return spark.createDataFrame(rows, SCHEMA)


def test_no_task_over_its_share(spark, burst):
    ranges = ranges_of(burst, ["k"], "ts", ["id"], 1_000)
    sizes = [r["count"] for r in with_range(burst, ranges).groupBy("k", "_range").count().collect()]
    assert max(sizes) <= 2_000 and len([s for s in sizes if s > 100]) >= 15
    assert ranges.cuts.count() == 1                                   # only the heavy key is cut
    got = next_in_sequence(burst, ["k"], "ts", ["id"], value="v", out_col="o", hot_rows=1_000)
    assert sorted(map(str, got.collect())) == by_window(burst, "v", F.lead)


def test_a_heavy_key_without_a_tiebreak_is_cut_by_the_row_hash(spark, burst):
    sizes = [r["count"] for r in with_range(burst, ranges_of(burst, ["k"], "ts", [], 1_000))
             .groupBy("k", "_range").count().collect()]
    assert max(sizes) <= 2_000
    got = next_in_sequence(burst, ["k"], "ts", out_col="o", hot_rows=1_000)     # equal times: any order, one answer
    want = burst.withColumn("o", F.lead("ts", 1).over(Window.partitionBy("k").orderBy("ts")))
    count = lambda d: sorted((str(r["k"]), str(r["ts"]), str(r["o"]), r["count"])
                             for r in d.groupBy("k", "ts", "o").count().collect())
    assert count(got) == count(want)


def test_rules_agree_with_and_without_ranges(spark, burst):
    samples = burst.withColumn("score", F.col("id") % 5 / 4.0)
    def rule(**how):
        return sorted(map(str, monitoring.gauge_below(samples, "k", "ts", "score", 0.5, 0, ["id"],
                                                      as_of="2024-02-01 00:00:00", **how).collect()))
    assert rule(rows_per_range=700) == rule(bucket_unit=None) != []


def test_light_keys_take_the_plain_window(spark, burst):
    plan = next_in_sequence(burst, ["k"], "ts", ["id"], out_col="o")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
