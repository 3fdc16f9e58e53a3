"""Lineage graph, pipeline runs and data flows.

The lineage walk is breadth-first with one job per *level* (never per node):
frontier ⋈ edges, minus the nodes already visited.  The edges are written once as
a table bucketed by the end the walk starts from (:func:`store_edges`), so no level
exchanges them; a hub's edges are spread over several buckets.  Each new frontier
is written to the shared checkpoint folder, and its size is observed on that write.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import seconds_to_ms
from strata.session import scratch_path
from strata.sinks.writers import save_table

DEFAULT_MAX_DEPTH = 10

# Column names of the reference's lineage table.
EDGE_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("transformation_type", T.StringType()), T.StructField("pipeline_name", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("metadata", T.StringType()),
])


# ---------------------------------------------------------------- write side

def register_transformation(spark: SparkSession, root: str, source: str, target: str,
                            transformation_type: str, pipeline_name: str | None = None,
                            metadata: dict | None = None, as_of: _dt.datetime | None = None) -> None:
    """Append one edge (parallel edges are kept, as in the reference)."""
    ts = as_of or _dt.datetime.now()
    row = (source, target, transformation_type, pipeline_name, ts,
           json.dumps(metadata) if metadata is not None else None)
    spark.createDataFrame([row], EDGE_SCHEMA).write.mode("append").parquet(f"{root}/lineage")


# ---------------------------------------------------------------- walk

# Edges of one node above which it is a hub, whose edges are spread over several buckets.
HUB_EDGES = 1_000_000
# The directions of the reference's lineage queries.
UPSTREAM, DOWNSTREAM = "upstream", "downstream"
_ENDS = {UPSTREAM: ("target_table", "source_table"), DOWNSTREAM: ("source_table", "target_table")}
_EDGE_COLUMNS = ("source_table", "target_table", "transformation_type", "pipeline_name", "created_at")


@dataclass
class EdgeStore:
    """Edges written once for any number of walks.  ``edges[direction]`` is bucketed by
    ``_near``, the end a walk in that direction arrives at, and where there are hubs by
    ``_part`` too, the part of a hub's edges; ``hubs[direction]`` lists the hubs as
    (node, parts), None without any."""
    spark: SparkSession
    buckets: int
    edges: dict[str, DataFrame]
    hubs: dict[str, DataFrame | None]

    def meet(self, nodes: DataFrame, direction: str) -> DataFrame:
        """The edges at ``nodes(node, ...)``.  Only the nodes move: the edge side is read
        in its buckets.  A hub goes to every part of its edges."""
        e, hubs = self.edges[direction], self.hubs[direction]
        if hubs is None:
            return e.join(nodes, e["_near"] == nodes["node"])
        last = F.coalesce(F.col("parts"), F.lit(1)) - 1
        f = (nodes.join(hubs, "node", "left")
             .withColumn("_to", F.explode(F.sequence(F.lit(0), last))).drop("parts"))
        return e.join(f, (e["_near"] == f["node"]) & (e["_part"] == f["_to"])).drop("_to")


def _bucketed(df: DataFrame, buckets: int, columns: Sequence[str]) -> DataFrame:
    """Write ``df`` bucketed by ``columns`` and read it back.  The name in the session
    catalog is only needed for that and dropped again; the files stay."""
    spark = df.sparkSession
    name = f"strata_edges_{uuid.uuid4().hex}"
    save_table(df.repartition(buckets, *columns), name, bucket_by=(buckets, columns),
               path=scratch_path(spark, "edges"))
    out = spark.table(name)
    out.schema  # resolves the files and buckets before the name goes
    spark.sql(f"DROP TABLE {name}")
    return out


def store_edges(edges: DataFrame, directions: Sequence[str] = (UPSTREAM, DOWNSTREAM),
                hub_edges: int = HUB_EDGES) -> EdgeStore:
    """Write the edges once per direction, bucketed; a node with more than
    ``hub_edges`` edges at that end gets one part per ``hub_edges`` of them."""
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = edges.select(*_EDGE_COLUMNS)
    ends = F.explode(F.array(*[F.struct(F.lit(d).alias("direction"), F.col(_ENDS[d][0]).alias("node"))
                               for d in directions])).alias("n")
    seen = Observation("hubs")
    folder = scratch_path(spark, "hubs")
    (e.select(ends).select("n.*").where("node IS NOT NULL").groupBy("direction", "node")
     .agg(F.ceil(F.count(F.lit(1)) / F.lit(hub_edges)).cast("int").alias("parts")).where("parts > 1")
     .observe(seen, *[F.count_if(F.col("direction") == d).alias(d) for d in directions])
     .write.parquet(folder))
    hubs = spark.read.schema("direction string, node string, parts int").parquet(folder)
    store = EdgeStore(spark, buckets, {}, {})
    for d in directions:
        near = _ENDS[d][0]
        own = hubs.where(F.col("direction") == d).select("node", "parts") if seen.get[d] else None
        rows, by = e.withColumn("_near", F.col(near)), ["_near"]
        if own is not None:
            by.append("_part")
            # spread by the whole edge, so that parallel edges of two hubs part too
            rows = (e.join(own, e[near] == own["node"], "left").withColumn("_near", F.col(near))
                    .withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*_EDGE_COLUMNS), F.col("parts")), F.lit(0)).cast("int"))
                    .drop("node", "parts"))
        store.edges[d], store.hubs[d] = _bucketed(rows, buckets, by), own
    return store


def reach(store: EdgeStore, start: str | Sequence[str] | DataFrame, max_depth: int | None = None,
          directions: Sequence[str] | None = None) -> DataFrame:
    """``(node, direction, depth)`` of every node reachable from ``start`` with its
    smallest depth, both directions in one loop.  Without ``max_depth`` the walk ends
    when a level brings no new node."""
    spark = store.spark
    directions = list(directions or store.edges)
    root = scratch_path(spark, "walk")
    found = "node string, direction string, depth int"
    if isinstance(start, DataFrame):
        nodes = start.select(F.col(start.columns[0]).cast("string").alias("node")).distinct()
    else:
        names = [start] if isinstance(start, str) else sorted(set(start))
        nodes = spark.createDataFrame([(x,) for x in names], "node string").coalesce(1)
    both = F.explode(F.array(*[F.lit(d) for d in directions])).alias("direction")
    nodes.select("node", both).write.parquet(f"{root}/depth=0")
    depth, live = 0, {d: 1 for d in directions}
    while any(live.values()) and (max_depth is None or depth < max_depth):
        seen = spark.read.schema(found).parquet(root)
        frontier = spark.read.schema("node string, direction string").parquet(f"{root}/depth={depth}")
        steps = [store.meet(frontier.where(F.col("direction") == d), d)
                 .select(F.col(_ENDS[d][1]).alias("node"), F.lit(d).alias("direction"))
                 for d in directions if live[d]]
        new = reduce(DataFrame.unionByName, steps).where("node IS NOT NULL").distinct()
        new = new.join(seen.select("node", "direction"), ["node", "direction"], "left_anti")
        size = Observation("frontier")
        depth += 1
        (new.observe(size, *[F.count_if(F.col("direction") == d).alias(d) for d in directions])
         .write.parquet(f"{root}/depth={depth}"))
        live = size.get
    return spark.read.schema(found).parquet(root)


def walk(edges: DataFrame | EdgeStore, start: str | Sequence[str] | DataFrame, direction: str = UPSTREAM, *,
         max_depth: int | None = DEFAULT_MAX_DEPTH, limit: int | None = None) -> DataFrame:
    """Every edge reachable from ``start``, with the BFS depth of the node
    it was reached from (direct edges have depth 0).  ``start`` may be several
    tables (names, or the first column of a DataFrame): one walk from the set, depth
    counted from the nearest of them.

    * a node is expanded once, at its smallest depth (cycles terminate);
    * all parallel edges of an expanded node are emitted;
    * edges of nodes at depth ``0..max_depth`` are emitted (None: of all nodes);
    * ``limit`` (L4) optionally cuts the result, ordered by depth then newest.

    Give an :class:`EdgeStore` to walk several times over edges written once.
    """
    store = edges if isinstance(edges, EdgeStore) else store_edges(edges, [direction])
    nodes = reach(store, start, max_depth, [direction])
    out = store.meet(nodes, direction).select(*_EDGE_COLUMNS, "depth")
    if limit is not None:
        out = out.orderBy(F.col("depth"), F.col("created_at").desc(), F.col(_ENDS[direction][1])).limit(limit)
    return out


def lineage_graph(edges: DataFrame | EdgeStore, table: str, max_depth: int | None = DEFAULT_MAX_DEPTH) -> DataFrame:
    """Both directions, tagged with ``direction``; one loop serves both."""
    store = edges if isinstance(edges, EdgeStore) else store_edges(edges)
    nodes = reach(store, table, max_depth)
    return reduce(DataFrame.unionByName, [
        store.meet(nodes.where(F.col("direction") == d), d).select(*_EDGE_COLUMNS, "depth", "direction")
        for d in (UPSTREAM, DOWNSTREAM)])


def impact(edges: DataFrame | EdgeStore, table: str | Sequence[str] | DataFrame,
           max_depth: int | None = None) -> DataFrame:
    """Every table affected by ``table`` (or a set of tables) with its
    nearest distance, however far away."""
    down = walk(edges, table, DOWNSTREAM, max_depth=max_depth)
    return (down.groupBy(F.col("target_table").alias("affected_table"))
            .agg((F.min("depth") + 1).alias("distance")))


# ---------------------------------------------------------------- runs

def current_runs(run_events: DataFrame) -> DataFrame:
    """G7 current view: per run, its start and its latest status.

    ``run_events`` is the append-only log ``(run_id, pipeline_name, run_type,
    status, event_ts, error_message)``: a ``running`` event at start and one
    event at completion.  Open runs are those whose latest status is running.
    """
    agg = run_events.groupBy("run_id").agg(
        F.min("event_ts").alias("started_at"),
        F.max_by(F.struct("status", "event_ts", "error_message", "pipeline_name", "run_type"),
                 F.struct("event_ts", (F.col("status") != "running").alias("_final")))
        .alias("_last"))
    last = F.col("_last")
    return agg.select("run_id", last["pipeline_name"].alias("pipeline_name"),
                      last["run_type"].alias("run_type"), last["status"].alias("status"), "started_at",
                      F.when(last["status"] != "running", last["event_ts"]).alias("completed_at"),
                      last["error_message"].alias("error_message"))


def pipeline_history(runs: DataFrame, pipeline_name: str | None = None, limit: int = 10) -> DataFrame:
    """Newest runs of a pipeline (or newest ``limit`` runs of *each*
    pipeline when ``pipeline_name`` is None: one job serves every pipeline).

    The per-pipeline top-k uses ``row_number() <= k``, which Spark runs as a
    partial group limit before the shuffle, so a busy pipeline sends at most
    k rows per map task.
    """
    if pipeline_name is not None:
        return (runs.filter(F.col("pipeline_name") == pipeline_name)
                .orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(limit))
    from pyspark.sql import Window
    w = Window.partitionBy("pipeline_name").orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return runs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def latest_status(runs: DataFrame) -> DataFrame:
    """R2 input: each pipeline's latest run and its status."""
    return (runs.groupBy("pipeline_name")
            .agg(F.max_by(F.struct("run_id", "status", "started_at"),
                          F.struct("started_at", "run_id")).alias("_l"))
            .select("pipeline_name", F.col("_l.run_id").alias("run_id"),
                    F.col("_l.status").alias("status"), F.col("_l.started_at").alias("started_at")))


# ---------------------------------------------------------------- flows

def flow_stats(flows: DataFrame) -> DataFrame:
    """G12 at scale: per run, number of flows and totals."""
    return flows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("records_read").alias("records_read"), F.sum("records_written").alias("records_written"),
        F.sum("bytes_read").alias("bytes_read"), F.sum("bytes_written").alias("bytes_written"),
        F.round(F.sum("duration_seconds"), 6).alias("duration_seconds"))


def flow_access_rows(flows: DataFrame, user: str = "system") -> DataFrame:
    """The two access-log rows each flow implies: a ``read`` of the source
    and a ``write`` of the target, only when that count is non-zero (a zero
    count logs nothing); duration in whole ms, null when zero."""
    ms = seconds_to_ms(F.col("duration_seconds"))
    pairs = F.array(
        F.struct(F.lit("read").alias("access_type"), F.col("source_table").alias("table_name"),
                 F.col("records_read").alias("rows_affected")),
        F.struct(F.lit("write").alias("access_type"), F.col("target_table").alias("table_name"),
                 F.col("records_written").alias("rows_affected")))
    x = flows.select("run_id", "timestamp", ms.alias("duration_ms"), F.inline(pairs))
    return (x.filter(F.coalesce(F.col("rows_affected"), F.lit(0)) != 0)
            .withColumn("user", F.lit(user)).withColumn("status", F.lit("success")))


# ---------------------------------------------------------------- write side

# Column names of the reference's run and flow tables.
RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("pipeline_name", T.StringType()),
    T.StructField("run_type", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()), T.StructField("error_message", T.StringType()),
    T.StructField("metadata", T.StringType()),
])
FLOW_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()), T.StructField("records_read", T.LongType()),
    T.StructField("records_written", T.LongType()), T.StructField("bytes_read", T.LongType()),
    T.StructField("bytes_written", T.LongType()), T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
# Run statuses of the reference.
RUN_STATUS = ("running", "success", "failed", "partial")


def _exists(spark: SparkSession, path: str) -> bool:
    from strata.sinks.writers import _fs
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def start_run(spark: SparkSession, root: str, pipeline_name: str, run_type: str = "batch",
              metadata: dict | None = None, as_of: _dt.datetime | None = None) -> int:
    """Append a ``running`` event; the run id is max + 1 (single writer)."""
    path = f"{root}/run_events"
    last = (spark.read.schema(RUN_EVENT_SCHEMA).parquet(path).agg(F.max("run_id")).first()[0]
            if _exists(spark, path) else None)
    run_id = (last or 0) + 1
    row = (run_id, pipeline_name, run_type, "running", as_of or _dt.datetime.now(), None,
           json.dumps(metadata) if metadata else None)
    spark.createDataFrame([row], RUN_EVENT_SCHEMA).write.mode("append").parquet(path)
    return run_id


def complete_run(spark: SparkSession, root: str, run_id: int, pipeline_name: str, status: str = "success",
                 error_message: str | None = None, run_type: str = "batch",
                 as_of: _dt.datetime | None = None) -> None:
    """Append the final event of a run (success / failed / partial)."""
    if status not in RUN_STATUS:
        raise ValueError(status)
    row = (run_id, pipeline_name, run_type, status, as_of or _dt.datetime.now(), error_message, None)
    spark.createDataFrame([row], RUN_EVENT_SCHEMA).write.mode("append").parquet(f"{root}/run_events")


def flow_row(run_id: int, source: str, target: str, records_read: int | None,
             records_written: int | None, bytes_read: int | None = None, bytes_written: int | None = None,
             duration_seconds: float | None = None, as_of: _dt.datetime | None = None) -> tuple:
    """One data-flow row (G8) for :func:`record_flows`."""
    return (run_id, source, target, records_read, records_written, bytes_read, bytes_written,
            duration_seconds, as_of or _dt.datetime.now())


def record_flows(spark: SparkSession, root: str, rows: list[tuple], user: str = "system") -> None:
    """Append flows and the access rows they imply (non-zero counts only),
    one write each."""
    if not rows:
        return
    flows = spark.createDataFrame(rows, FLOW_SCHEMA).coalesce(1)
    flows.write.mode("append").parquet(f"{root}/data_flows")
    from strata.operators.audit import append_log, row_id
    acc = flow_access_rows(flows, user).select(
        row_id().alias("access_id"), "timestamp", "user", "table_name", "access_type", "rows_affected",
        F.lit(None).cast("string").alias("query"), "status", "duration_ms",
        F.to_json(F.struct("run_id")).alias("details"))
    append_log(acc, f"{root}/data_access_log")


def record_flow(spark: SparkSession, root: str, run_id: int, source: str, target: str,
                records_read: int | None, records_written: int | None, bytes_read: int | None = None,
                bytes_written: int | None = None, duration_seconds: float | None = None,
                user: str = "system", as_of: _dt.datetime | None = None) -> None:
    """Append one flow and its access rows."""
    record_flows(spark, root, [flow_row(run_id, source, target, records_read, records_written,
                                        bytes_read, bytes_written, duration_seconds, as_of)], user)


def open_runs(runs: DataFrame, as_of=None, max_minutes: int = 60) -> DataFrame:
    """Runs still ``running`` (no completion event) longer than
    ``max_minutes`` at ``as_of`` - typically runs whose driver was lost."""
    from strata.functions.scalar import as_of_ts, epoch_seconds
    age = epoch_seconds(as_of_ts(as_of)) - epoch_seconds(F.col("started_at"))
    return (runs.filter(F.col("status") == "running").withColumn("age_s", age)
            .filter(F.col("age_s") > max_minutes * 60))
