"""Streaming: late rows beyond the watermark are dropped; foreachBatch merge
is idempotent on replay; stream == batch for the merge."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from strata.sinks.writers import committed_versions, read_current
from strata.streaming import layers as st

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def _file(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))
    time.sleep(1.1)          # distinct modification times: files arrive in this order


def test_late_rows_are_dropped(spark, tmp):
    """One file per micro-batch.  The 10:05 row arrives after the watermark
    (15:00) has already closed and written its window: it is dropped and the
    window is never rewritten.  The 13:01 row arrives before its window is
    closed and is counted.  The open 16:00 window is not written."""
    src = os.path.join(tmp, "in")
    t = dt.datetime(2024, 1, 1, 10)
    _file(spark, src, "a", [(1, t, 1, "view"), (2, t + dt.timedelta(hours=3), 1, "view")])
    _file(spark, src, "b", [(5, t + dt.timedelta(hours=6), 2, "view")])
    _file(spark, src, "c", [(3, t + dt.timedelta(minutes=5), 2, "view"),
                            (4, t + dt.timedelta(hours=3, minutes=1), 2, "view")])
    schema = spark.createDataFrame([], SCHEMA).schema
    s = st.read_files(spark, src, schema, max_files_per_trigger=1, recursive=True)
    out = st.run_available_now(st.window_counts(st.event_time(s, "ts"), "ts", "1 hour", ["event_type"],
                                                "1 hour"), name="late", path=os.path.join(tmp, "late"))
    rows = spark.read.parquet(f"{out}/data").collect()
    got = [(r["window_start"].hour, r["events"]) for r in rows]
    assert sorted(got) == [(10, 1), (13, 2)]


def test_a_hot_key_sends_one_row_a_task(spark, monkeypatch):
    t = "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)"
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS event_id", f"CASE WHEN id % 10 = 3 THEN NULL ELSE {t} END AS ts", "CASE WHEN id % 10 < 9 THEN 7 ELSE id END AS user_id",
        "CASE WHEN id % 1000 = 0 THEN NULL ELSE 'view' END AS event_type", "map('a', id) AS extra")
    got = st.newest_per_task(rows, ["USER_ID", "event_type"], "ts")
    assert got.schema == rows.schema
    timed = got.where("user_id = 7 AND ts IS NOT NULL AND event_type IS NOT NULL").orderBy("event_id").collect()
    assert [r.event_id for r in timed] == [9_998, 19_998, 29_998, 39_998]     # the newest of each task
    assert all(r.extra == {"a": r.event_id} for r in timed)
    assert got.where("user_id = 7 AND event_type IS NULL").count() == 4
    assert got.where("ts IS NULL").count() == 4_000                           # no time: all stay
    assert got.where("user_id <> 7").count() == 4_000                         # other keys: none lost
    monkeypatch.setattr(st, "HELD_KEYS", 10)
    assert st.newest_per_task(rows, ["user_id", "event_type"], "ts").where("user_id <> 7").count() == 4_000


def test_dedup_forgets_a_key_after_its_delay(spark, tmp):
    """A micro-batch per file, a delay of one hour.  Repeats in a file and within the hour
    go; after the watermark has passed the first row by an hour the key counts as new."""
    src, t = os.path.join(tmp, "in"), dt.datetime(2024, 1, 1)

    def at(hours):
        return t + dt.timedelta(hours=hours)
    files = [[(1, at(0), 1, "view"), (2, at(0), 1, "view"), (3, at(0.2), 2, "view")],
             [(4, at(0.5), 1, "view"), (5, at(6), 3, "view")],
             [(6, at(6.2), 4, "view")],
             # Spark drops late rows by the watermark of the batch before (5:00): user 9's row and
             # user 5's first one, which must not stand in for the second.
             [(8, at(6.5), 1, "view"), (9, at(6.6), 3, "view"), (10, at(6.5), 1, "view"),
              (7, at(0.1), 9, "view"), (11, at(0.1), 5, "view"), (12, at(6.7), 5, "view")]]
    for i, rows in enumerate(files):
        _file(spark, src, f"f{i}", rows)
    schema = spark.createDataFrame([], SCHEMA).schema
    s = st.read_files(spark, src, schema, max_files_per_trigger=1, recursive=True)
    out = st.run_available_now(st.dedup(st.event_time(s, "ts"), ["user_id"], "ts", "1 hour"), name="expiry",
                               path=os.path.join(tmp, "expiry"))
    spark.read.parquet(f"{out}/data").createOrReplaceTempView("kept_rows")
    got = spark.sql("SELECT user_id, count(*) AS n, max(event_id) AS newest FROM kept_rows GROUP BY user_id").collect()
    assert {r.user_id: r.n for r in got} == {1: 2, 2: 1, 3: 1, 4: 1, 5: 1}
    assert {r.user_id: r.newest for r in got if r.user_id != 1} == {2: 3, 3: 5, 4: 6, 5: 12}


def test_merge_into_replay_is_skipped(spark, tmp):
    base = os.path.join(tmp, "silver")
    apply = st.merge_into(base, "user_id", ["ts", "event_id"])
    t = dt.datetime(2024, 1, 1)
    b0 = spark.createDataFrame([(1, t, 1, "a"), (2, t, 2, "b")], SCHEMA)
    b1 = spark.createDataFrame([(3, t + dt.timedelta(1), 1, "c"), (4, t - dt.timedelta(1), 2, "late")], SCHEMA)
    apply(b0, 0)
    apply(b1, 1)
    apply(b1, 1)                 # replay after a failure: no new version
    assert committed_versions(spark, base) == [1, 2]
    cur = {r["user_id"]: r["event_type"] for r in read_current(spark, base).collect()}
    assert cur == {1: "c", 2: "b"}   # the older late row did not overwrite user 2


def test_merge_into_seeded_table_and_new_checkpoint(spark, tmp):
    """A seeded target and a second query with a fresh checkpoint: no batch is lost."""
    from strata.sinks.writers import write_version
    base, t = os.path.join(tmp, "silver"), dt.datetime(2024, 1, 1)
    write_version(spark.createDataFrame([(1, t, 1, "seed"), (2, t, 2, "seed")], SCHEMA), base)
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, (rows, want) in enumerate([([(3, t + dt.timedelta(1), 1, "new")], {1: "new", 2: "seed"}),
                                      ([(4, t + dt.timedelta(2), 2, "newer")], {1: "new", 2: "newer"})]):
        src = os.path.join(tmp, f"in{i}")
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, "a"))
        s = st.read_files(spark, src, schema, recursive=True)
        st.run_available_now(s, name="m", sink=st.merge_into(base, "user_id", ["ts", "event_id"]),
                             path=os.path.join(tmp, f"q{i}"))
        assert {r["user_id"]: r["event_type"] for r in read_current(spark, base).collect()} == want


def test_quality_log_survives_a_new_checkpoint(spark, tmp):
    base, t = os.path.join(tmp, "log"), dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], SCHEMA).schema
    src = os.path.join(tmp, "in")
    spark.createDataFrame([(1, t, 1, "a"), (2, t, 2, "b")], SCHEMA).coalesce(1).write.parquet(os.path.join(src, "a"))
    for i in range(2):
        s = st.read_files(spark, src, schema, recursive=True)
        st.run_available_now(s, name="q", sink=st.quality_into(base, lambda b: b.groupBy().count()),
                             path=os.path.join(tmp, f"q{i}"))
    assert [r["count"] for r in spark.read.parquet(base).collect()] == [2, 2]


def test_merge_over_many_batches_equals_batch(spark, tmp):
    """Events split over four files (one micro-batch each, rows of a user
    spread across batches out of time order): the merged silver equals the
    batch latest-per-user."""
    from strata.operators import silver
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id", "event_type", "ts")
    src = os.path.join(tmp, "in")
    for i in range(4):
        ev.filter(F.col("event_id") % 4 == 3 - i).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
        time.sleep(1.1)
    s = st.read_files(spark, src, ev.schema, max_files_per_trigger=1, recursive=True)
    base = os.path.join(tmp, "merge")
    st.run_available_now(s, name="m", sink=st.merge_into(f"{base}/silver", "user_id", ["ts", "event_id"]),
                         path=base)
    assert committed_versions(spark, f"{base}/silver") == [1, 2, 3, 4]
    got = sorted(map(tuple, read_current(spark, f"{base}/silver").select(*ev.columns).collect()))
    want = sorted(map(tuple, silver.keep_latest(ev, "user_id", ["ts", "event_id"]).collect()))
    assert got == want


def test_sessions_are_merged_before_the_shuffle(spark, tmp):
    """One busy user: each task sends its own sessions, not its rows, and the rows out are the same."""
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start + dt.timedelta(seconds=7 * i)) for i in range(600)]
    rows += [(u, start + dt.timedelta(minutes=50 * u)) for u in range(2, 5)]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp")
    df.repartition(4).write.parquet(f"{tmp}/in")
    found = {}
    for name, conf in (("plain", {}), ("first", st.MERGE_SESSIONS_FIRST)):
        before = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            s = st.sessions(st.read_files(spark, f"{tmp}/in", df.schema), "ts", "30 minutes", ["user_id"], "1 hour")
            q = (s.writeStream.format("memory").queryName(f"sessions_{name}").outputMode("append")
                 .option("checkpointLocation", f"{tmp}/cp_{name}").trigger(availableNow=True).start())
            q.awaitTermination()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        plan = q._jsq.explainInternal(False)
        below = plan[plan.index("Exchange hashpartitioning"):]
        found[name] = ("MergingSessions" in below, sorted(map(str, spark.table(f"sessions_{name}").collect())))
    assert (found["plain"][0], found["first"][0]) == (False, True)
    assert found["plain"][1] == found["first"][1] != []
