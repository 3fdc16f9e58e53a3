"""Incremental loads, merges, history and retention.

All of these are plain DataFrame plans; applying them to storage goes
through :func:`strata.sinks.writers.write_version` (write new, then switch),
because Parquet folders cannot be updated in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.scalar import as_of_ts
from strata.operators.audit import action_row, log_actions
from strata.operators.sequence import next_in_sequence
from strata.operators.silver import keep_latest
from strata.sinks.writers import path_exists, read_current, write, write_version

EPOCH = "1970-01-01 00:00:00"
_STATE = "table_name string, watermark timestamp_ntz"


# ---------------------------------------------------------------- watermarks

def watermark_of(state: DataFrame | None, table_name: str) -> Column:
    """The stored watermark of ``table_name`` as a scalar subquery, or the
    epoch when the state table has no row for it."""
    if state is None:
        return F.lit(EPOCH).cast("timestamp_ntz")
    wm = state.filter(F.col("table_name") == table_name).agg(F.max("watermark").alias("w"))
    return F.coalesce(wm.select("w").scalar(), F.lit(EPOCH).cast("timestamp_ntz"))


def new_rows(source: DataFrame, ts_col: str, watermark, lookback: str | None = None) -> DataFrame:
    """P10 + I3: rows strictly newer than the watermark, optionally reaching
    back ``lookback`` (e.g. ``'7 days'``) to pick up late arrivals."""
    wm = watermark if isinstance(watermark, Column) else F.lit(str(watermark)).cast("timestamp_ntz")
    if lookback:
        wm = wm - F.expr(f"INTERVAL {lookback}")
    return source.filter(F.col(ts_col) > wm)


def next_state(batch: DataFrame, table_name: str, ts_col: str, previous) -> DataFrame:
    """The state row after loading ``batch``: the greatest timestamp actually
    processed (never wall-clock time, which would skip rows stamped before
    it but visible later); unchanged for an empty batch."""
    prev = previous if isinstance(previous, Column) else F.lit(str(previous)).cast("timestamp_ntz")
    return batch.agg(F.max(ts_col).alias("m")).select(
        F.lit(table_name).alias("table_name"), F.coalesce(F.col("m"), prev).alias("watermark"))


def load_increment(source: DataFrame, table_name: str, ts_col: str, root: str) -> int:
    """I1 + U1 as one step: read the stored watermark, append the newer rows,
    advance the watermark.  Returns the rows appended.

    A batch is the folder ``data/after=<watermark>`` of the watermark it starts
    from, and the state is written after it: a load repeated after a failure
    overwrites its own rows, so no row is lost or doubled.  The new watermark
    is the newest timestamp written, observed on the write itself; an empty
    batch leaves the state as it is.
    """
    spark = source.sparkSession
    state = spark.read.schema(_STATE).parquet(f"{root}/state") if path_exists(spark, f"{root}/state") else None
    low = (state.filter(F.col("table_name") == table_name).agg(F.max("watermark")).first()[0]
           if state is not None else None)
    seen = Observation("increment")
    batch = new_rows(source, ts_col, low or EPOCH).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(ts_col).cast("timestamp_ntz").alias("newest"))
    after = (low.isoformat() if low else EPOCH.replace(" ", "T")).replace(":", "")
    batch.write.mode("overwrite").parquet(f"{root}/data/{table_name}/after={after}")
    got = seen.get
    if got["newest"] is not None:
        (spark.createDataFrame([(table_name, got["newest"])], _STATE).coalesce(1)
         .write.mode("append").parquet(f"{root}/state"))
    return got["rows"]


def loaded(spark, table_name: str, root: str, schema) -> DataFrame:
    """All rows that :func:`load_increment` appended for a table."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/data/{table_name}")


# ---------------------------------------------------------------- merge

def merge_upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str], *,
                 sync_columns: bool = True) -> DataFrame:
    """The merged table = updates + target rows whose key is not updated.

    ``updates`` must hold one row per key (see :func:`keep_latest`).  With
    ``sync_columns`` (D5, ``sync_all_columns``) the result has exactly the
    update's columns: new columns are added (null for untouched target rows),
    columns missing from the update are dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    if sync_columns:
        kept = kept.select(*[F.col(c) if c in kept.columns else
                             F.lit(None).cast(updates.schema[c].dataType).alias(c)
                             for c in updates.columns])
        return updates.unionByName(kept)
    return updates.unionByName(kept, allowMissingColumns=True)


def rows_to_update(target: DataFrame, changed_keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows whose key appears in ``changed_keys`` (semi join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.join(changed_keys.select(*keys), keys, "left_semi")


def incremental_model(source: DataFrame, target: DataFrame | None, key: str, ts_col: str,
                      *, target_ts_col: str | None = None, lookback: str | None = None) -> DataFrame:
    """The incremental silver model.

    Source rows newer than the target's newest timestamp (J4 scalar
    subquery, epoch when the target is empty) are reduced to the latest row
    per key (D3) and merged on the key (D4).
    """
    if target is None:
        return keep_latest(source, key, [ts_col])
    tcol = target_ts_col or ts_col
    wm = target.agg(F.max(tcol)).scalar()
    # An empty target has no maximum: take everything (a plain ``>`` against
    # NULL would select nothing).
    lower = wm - F.expr(f"INTERVAL {lookback}") if lookback else wm
    fresh = keep_latest(source.filter(wm.isNull() | (F.col(ts_col) > lower)), key, [ts_col])
    return merge_upsert(target, fresh, key)


def cdc_merge(state: DataFrame | None, changes: DataFrame, key: str | Sequence[str], *,
              op_col: str = "op", order_col: str = "seq") -> DataFrame:
    """The change state after a batch of changes: per key the change with the
    greatest ``order_col``, deletes included as tombstones.

    The state keeps what each row's order was, so a change that arrives late loses to
    a newer row and does not bring a deleted key back; a batch applied twice changes
    nothing.  At equal order the incoming change wins.  A state without ``op_col`` or
    ``order_col`` (a plain table) holds rows older than any change.  Partial
    aggregation: a hot key costs one row per map task.  Nulls in ``order_col`` stand
    before all numbers.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = changes.withColumn("_cdc_new", F.lit(1))
    if state is not None:
        for c in (op_col, order_col):
            if c not in state.columns:
                state = state.withColumn(c, F.lit(None).cast(changes.schema[c].dataType))
        rows = rows.unionByName(state.withColumn("_cdc_new", F.lit(0)), allowMissingColumns=True)
    return keep_latest(rows, keys, [order_col, "_cdc_new"]).drop("_cdc_new").select(
        *[c for c in rows.columns if c != "_cdc_new"])


def cdc_rows(state: DataFrame, op_col: str = "op", delete_op: str = "D") -> DataFrame:
    """The live rows of a change state (no tombstones, no operation column)."""
    return state.filter(~F.col(op_col).eqNullSafe(F.lit(delete_op))).drop(op_col)


def cdc_compact(state: DataFrame, older_than, *, op_col: str = "op", order_col: str = "seq",
                delete_op: str = "D") -> DataFrame:
    """Drop tombstones whose order is below ``older_than``: the oldest change that can
    still arrive.  Live rows stay."""
    gone = F.col(op_col).eqNullSafe(F.lit(delete_op)) & (F.col(order_col) < F.lit(older_than))
    return state.filter(~F.coalesce(gone, F.lit(False)))


def cdc_apply(target: DataFrame | None, changes: DataFrame, key: str | Sequence[str], *,
              op_col: str = "op", order_col: str = "seq", delete_op: str = "D") -> DataFrame:
    """Apply a change feed (insert / update / delete) to a table and return its rows.

    The latest change per key wins, also against the target's own ``order_col`` where
    it has one; keys whose latest change is a delete disappear.  To apply batch after
    batch, keep :func:`cdc_merge`'s state, whose tombstones hold late changes off.
    """
    return cdc_rows(cdc_merge(target, changes, key, op_col=op_col, order_col=order_col), op_col, delete_op)


# ---------------------------------------------------------------- history

def snapshot_history(df: DataFrame, key: str | Sequence[str], updated_at: str,
                     tiebreak: Sequence[str] = (), *, bucket: str | None = "auto") -> DataFrame:
    """SCD type 2 from versions: ``valid_from``, ``valid_to`` (the next
    version's start, null for the current one) and ``is_current``.

    ``next_in_sequence`` finds the next version without putting all versions
    of a key into one task (see :mod:`strata.operators.sequence`).
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = next_in_sequence(df, keys, updated_at, tiebreak, out_col="valid_to", bucket=bucket)
    return (out.withColumn("valid_from", F.col(updated_at))
            .withColumn("is_current", F.col("valid_to").isNull()))


# ---------------------------------------------------------------- retention

def expired(df: DataFrame, ts_col: str, days: int | Column, as_of=None) -> Column:
    """True for rows older than ``as_of - days``."""
    d = days if isinstance(days, Column) else F.lit(days)
    return F.col(ts_col) < as_of_ts(as_of) - F.make_dt_interval(days=d)


def retention_split(df: DataFrame, ts_col: str, days: int | Column, as_of=None) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) rows; the expired part is what gets archived."""
    e = expired(df, ts_col, days, as_of)
    return df.filter(~e), df.filter(e)


def archive_expired(df: DataFrame, ts_col: str, days: int | Column, path: str, as_of: str) -> int:
    """Write the expired rows, whole, to the archive, in a folder per run
    (``as_of``) and day; a day that holds most rows is split over several files.
    A run that is repeated replaces its own days only, and nothing if its rows
    have left the table since.  Returns the rows written."""
    _, old = retention_split(df, ts_col, days, as_of)
    run = str(as_of).replace(" ", "T").replace(":", "")
    return write(old.withColumn("archive_date", F.to_date(ts_col)), f"{path}/run={run}",
                 partition_by=["archive_date"], dynamic_partitions=True)


def retention_report(df: DataFrame, layer_col: str, ts_col: str, days_by_layer: dict[str, int],
                     as_of=None) -> DataFrame:
    """I4 report: rows kept and expired per layer, before anything is rewritten."""
    days = F.element_at(F.create_map(*[x for k, v in days_by_layer.items()
                                       for x in (F.lit(k), F.lit(v))]), F.col(layer_col))
    e = expired(df, ts_col, days, as_of)
    return (df.groupBy(layer_col)
            .agg(F.count_if(~e).alias("kept_rows"), F.count_if(e).alias("expired_rows"),
                 F.first(days).alias("retention_days")))


def erase_in_layers(spark, layers: dict[str, tuple[str, str]], subjects: DataFrame, subject_key: str,
                    gov_root: str, user: str = "system", as_of=None) -> dict[str, int]:
    """I6 over every layer: ``layers`` maps a table name to its versioned folder
    and subject column.  Each is rewritten as a new version without the subjects,
    and its audit row, with the rows left, is written before the next layer is touched,
    so a failure in between leaves no erasure unrecorded.  A layer without a committed
    version has nothing to erase and 0 rows left.  Returns those counts."""
    left = {}
    for name, (path, key) in layers.items():
        rows = read_current(spark, path)
        left[name] = 0 if rows is None else write_version(erase_subjects(rows, subjects, key, subject_key), path)[1]
        log_actions(spark, gov_root, [action_row(user, "erase_subjects", "table", name,
                                                 details={"rows_left": left[name]}, as_of=as_of)])
    return left


def erase_subjects(df: DataFrame, subjects: DataFrame, key: str, subject_key: str | None = None) -> DataFrame:
    """Drop every row of the given subjects (anti join on the subject key)."""
    sk = subject_key or key
    return df.join(subjects.select(F.col(sk).alias("_sk")).distinct(),
                   F.col(key) == F.col("_sk"), "left_anti")
