"""Structured Streaming counterpart of the layered flow.

* bronze: file source of arriving files + provenance, appended to Parquet;
* silver: watermark + state-bounded dedup; rows later than the watermark are
  dropped (that is what the watermark is for);
* gold: event-time windows and sessions in append mode - a window is written
  once, when the watermark passes its end, so nothing is rewritten;
* merge / quality: ``foreachBatch`` running the batch operators on each
  micro-batch, idempotent by query and batch id so a replayed batch after a
  failure does not apply twice.

Checkpoints and outputs live under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import file_stem
from strata.operators.silver import keep_latest
from strata.sinks.writers import committed_folders, read_current, write_version
from strata.session import scratch_path


def read_files(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet",
               glob: str | None = None, max_files_per_trigger: int | None = None,
               recursive: bool = False) -> DataFrame:
    """A stream of the files arriving in ``path`` (explicit schema);
    ``max_files_per_trigger`` bounds each micro-batch."""
    r = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need ``timestamp``; the tables carry ``timestamp_ntz``."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def bronze(stream: DataFrame, source_system: str | None = None) -> DataFrame:
    """Provenance stamps on every arriving row."""
    out = stream.withColumns({"_ingestion_timestamp": F.localtimestamp(),  # same type as batch bronze
                              "_source_file": file_stem(F.col("_metadata.file_path"))})
    return out.withColumn("source_system", F.lit(source_system)) if source_system else out


#: Rows of distinct keys a task holds before it sends them on.
HELD_KEYS = 1 << 18


def newest_per_task(stream: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Of each key's rows in a task of a micro-batch the newest, so a hot key sends a row
    a task to the state instead of all its repeats.  The newest, because a row later than
    the watermark must not stand in for one that is not.  Rows without a time all stay,
    and a task with over ``HELD_KEYS`` keys sends what it holds and starts anew.  Keys are
    plain values; Spark has no such step of its own, so it runs on Arrow batches."""
    column = {c.lower(): c for c in stream.columns}
    names, time, held_keys = [column[k.lower()] for k in keys], column[ts.lower()], HELD_KEYS

    def newest(rows):
        import pyarrow as pa
        rows = rows.sort_by(time)
        at = rows.append_column("", pa.array(range(rows.num_rows), pa.int64())).group_by(names).aggregate([("", "max")])
        return rows.take(at["_max"])

    def run(batches):
        import pyarrow as pa
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            timed = rows[time].is_valid()
            yield from rows.filter(rows[time].is_null()).to_batches()
            rows = rows.filter(timed)
            held = newest(rows if held is None else pa.concat_tables([held, rows]))
            if held.num_rows > held_keys:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()
    return stream.mapInArrow(run, stream.schema)


def dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key seen within ``delay`` of event time;
    state per key expires once the watermark passes it."""
    stream = newest_per_task(stream, keys, ts)
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def window_counts(stream: DataFrame, ts: str, size: str, labels: Sequence[str], delay: str,
                  slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) event-time counts, final once closed."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (stream.withWatermark(ts, delay).groupBy(w.alias("window"), *labels)
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    *labels, "events"))


def sessions(stream: DataFrame, ts: str, gap: str, labels: Sequence[str], delay: str) -> DataFrame:
    """T4: activity sessions (a gap of ``gap`` closes a session).  Run it with
    ``conf=MERGE_SESSIONS_FIRST``: each task then sends one row per session of its own
    rows, so a busy user is not one task's input."""
    return (stream.withWatermark(ts, delay)
            .groupBy(F.session_window(ts, gap).alias("s"), *labels)
            .agg(F.count(F.lit(1)).alias("events"))
            .select(*labels, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "events"))


#: Sessions of a task's rows are merged before the shuffle as well as after it.
MERGE_SESSIONS_FIRST = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


# ---------------------------------------------------------------- foreachBatch operators

def merge_into(base: str, key: Sequence[str] | str, order_by: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """T5: a ``foreachBatch`` function keeping the latest row per key in a
    versioned Parquet table at ``base``.

    Each batch writes the next free version = latest-per-key over (current
    version ∪ batch), so an older late row never overwrites a newer one.  The
    version's folder names the query and batch that wrote it; only a batch
    that this query has already committed is skipped (replay after failure),
    so a seeded table or a new checkpoint loses nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tag = f"{_query_id(batch)}-b{batch_id}"
        if any(name.endswith(f"-{tag}") for name in committed_folders(spark, base)):
            return
        cur = read_current(spark, base)
        rows = batch if cur is None else cur.unionByName(batch)
        write_version(keep_latest(rows, keys, list(order_by)), base, tag=tag)

    return apply


def _query_id(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to: kept in its
    checkpoint, so the same after a restart; ``batch`` outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def quality_into(base: str, checks: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Run the check operators on each micro-batch and write the result
    rows to ``base/query_id=<id>/batch_id=<n>`` (overwritten on replay, so
    idempotent; another query or checkpoint has folders of its own)."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        checks(batch).write.mode("overwrite").parquet(
            f"{base.rstrip('/')}/query_id={_query_id(batch)}/batch_id={batch_id}")
    return apply


def state_partitions_for(spark: SparkSession, path: str, glob: str = "*",
                         bytes_per_partition: int = 128 * 1024 * 1024, lo: int = 8) -> int:
    """A state partition count proportional to the input size (driver-side
    file listing only), at least ``lo``."""
    import math

    from strata.sinks.writers import _fs
    fs, _, jvm = _fs(spark, path)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")) or []
    size = sum(int(fs.getContentSummary(st.getPath()).getLength()) for st in found)
    return max(lo, math.ceil(size / bytes_per_partition))


def run_available_now(df: DataFrame, *, name: str, sink: str | Callable = "parquet",
                      output_mode: str = "append", path: str | None = None,
                      state_partitions: int | None = None, conf: dict[str, str] | None = None) -> str:
    """Run a stream over everything available now, then stop; returns the
    output folder (under the shared checkpoint folder unless given).

    ``state_partitions`` sets the stream's shuffle / state partition count,
    which a stream fixes at its first start; ``conf`` are further settings of the
    stream alone.  The session's own settings are restored right after the start.
    """
    spark = df.sparkSession
    root = path or scratch_path(spark, name)
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True))
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink).option("path", f"{root}/data")
    wanted = dict(conf or {})
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        q = w.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    return root
