"""Randomised checks of the operators against small pure-Python models."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import lineage, monitoring, silver

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", " a", None]),   # key
                             st.integers(0, 5),                              # ts
                             st.integers(0, 3)),                             # payload
                   min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_st)
def test_keep_first_and_latest_match_model(spark, rows):
    data = [(k, ts, v, i) for i, (k, ts, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts int, v int, ord int")
    first = {r["k"]: r["ord"] for r in silver.keep_first(df, "k", "ord").collect()}
    model_first = {}
    for k, _, _, i in data:
        model_first.setdefault(k, i)
    assert first == model_first
    latest = {r["k"]: (r["ts"], r["v"], r["ord"]) for r in silver.keep_latest(df, "k", ["ts"]).collect()}
    model_latest = {}
    for k, ts, v, i in data:
        model_latest[k] = max(model_latest.get(k, (ts, v, i)), (ts, v, i))
    assert latest == model_latest


def _bfs(edges, starts, max_depth, upstream=True):
    """Breadth-first walk: each node expanded once at its smallest depth."""
    near, far = (1, 0) if upstream else (0, 1)
    out, seen, queue = [], set(), collections.deque([(s, 0) for s in sorted(set(starts))])
    while queue:
        node, d = queue.popleft()
        if node in seen or d > max_depth:
            continue
        seen.add(node)
        for e in edges:
            if e[near] == node:
                out.append((e[0], e[1], e[2], d))
                if d < max_depth:
                    queue.append((e[far], d + 1))
    return sorted(out)


edges_st = st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7), st.sampled_from(["x", "y"])),
                    min_size=1, max_size=25)


@SETTINGS
@given(edges=edges_st, starts=st.lists(st.integers(0, 7), min_size=1, max_size=3),
       depth=st.integers(0, 4), up=st.booleans())
def test_lineage_walk_matches_bfs(spark, edges, starts, depth, up):
    rows = [(f"n{s}", f"n{t}", k) for s, t, k in edges]
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(s, t, k, "p", ts, None) for s, t, k in rows], lineage.EDGE_SCHEMA)
    names = [f"n{x}" for x in starts]
    got = sorted((r["source_table"], r["target_table"], r["transformation_type"], r["depth"])
                 for r in lineage.walk(df, names if len(names) > 1 else names[0],
                                       "upstream" if up else "downstream", max_depth=depth).collect())
    assert got == _bfs(rows, names, depth, up)


@SETTINGS
@given(hours=st.sets(st.integers(0, 30), min_size=1, max_size=20), amounts=st.data(),
       min_buckets=st.integers(1, 4))
def test_sustained_matches_model(spark, hours, amounts, min_buckets):
    hs = sorted(hours)
    vals = {h: amounts.draw(st.integers(0, 6)) for h in hs}
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("l", base + dt.timedelta(hours=h), vals[h]) for h in hs],
                               "label string, bucket timestamp_ntz, amount int")
    got = sorted((r["start"].hour + 24 * (r["start"].day - 1), r["buckets"], r["amount"])
                 for r in monitoring.sustained(df, ["label"], F.col("amount") >= 3, 3600,
                                               min_buckets).collect())
    model, run = [], []
    for h in range(0, 32):
        if h in vals and vals[h] >= 3:
            run.append(h)
            continue
        if len(run) >= min_buckets:
            model.append((run[0], len(run), sum(vals[x] for x in run)))
        run = []
    assert got == sorted(model)


samples_st = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 200), st.floats(0, 1)),
                      min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(samples=samples_st, min_minutes=st.integers(1, 30))
def test_gauge_below_matches_model(spark, samples, min_minutes):
    base = dt.datetime(2024, 1, 1)
    as_of = base + dt.timedelta(minutes=300)
    rows = [(f"t{k}", base + dt.timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(samples)]
    df = spark.createDataFrame(rows, "label string, ts timestamp_ntz, id int, score double")
    got = sorted((r["label"], r["start"], r["end"], r["duration_s"]) for r in monitoring.gauge_below(
        df, "label", "ts", "score", 0.5, min_minutes * 60, tiebreak=["id"], as_of=as_of).collect())
    model = []
    for label in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == label), key=lambda r: (r[1], r[2]))
        i = 0
        while i < len(seq):
            if seq[i][3] < 0.5 and (i == 0 or seq[i - 1][3] >= 0.5):
                j = i + 1
                while j < len(seq) and seq[j][3] < 0.5:
                    j += 1
                end = seq[j][1] if j < len(seq) else None
                dur = int(((end or as_of) - seq[i][1]).total_seconds())
                if dur >= min_minutes * 60:
                    model.append((label, seq[i][1], end, dur))
            i += 1
    assert got == sorted(model, key=lambda t: (t[0], t[1], t[2] or as_of, t[3]))
