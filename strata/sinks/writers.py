"""Writers (K1-K8) and the versioned overwrite used by merge, retention and
erasure.

A plan must never overwrite the folder it reads.  ``write_version`` writes a
new ``v=<n>`` folder next to the old ones; the current version is the newest
folder whose job committed (Spark's ``_SUCCESS`` marker), so a failed write
leaves the previous version current.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def write(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: Sequence[str] | None = None, dynamic_partitions: bool = False,
          count: bool = True, options: dict | None = None) -> int | None:
    """K1-K5, K8: write a dataset; returns the row count written.

    The count comes from an ``Observation`` on the write itself (one pass, no
    second job).  With ``partition_by`` the data is rebalanced on the same
    keys: few files per folder, and adaptive execution splits a folder that
    holds most rows over several tasks.  ``dynamic_partitions``
    replaces only the partitions present in ``df`` (re-runnable date slices).
    """
    obs = Observation("write") if count else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    w = out.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return obs.get["rows"] if obs else None


# ---------------------------------------------------------------- fingerprints

@dataclass(frozen=True)
class Fingerprint:
    """Rows and the sum of their hashes: equal for equal multisets of rows, whatever
    their order and files.  Fingerprints of the parts of a split add up to the whole's."""
    rows: int
    digest: int

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.rows + other.rows, self.digest + other.digest)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A 64-bit hash of a row; a null is told from a missing neighbour, and maps hash by
    their sorted entries."""
    def hashable(c: str) -> Column:
        return F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c)

    columns = list(columns or df.columns)
    return F.xxhash64(*[hashable(c) for c in columns], *[F.col(c).isNull() for c in columns])


def fingerprint_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The aggregates of a fingerprint, for ``observe`` or ``agg``."""
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_hash(df, columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("digest")]


def write_fingerprinted(df: DataFrame, path: str, columns: Sequence[str] | None = None, **how) -> Fingerprint:
    """:func:`write`, with the fingerprint of ``columns`` (all, unless given) observed on
    the write itself: layers are reconciled without being read again."""
    seen = Observation("fingerprint")
    write(df.observe(seen, *fingerprint_columns(df, columns)), path, count=False, **how)
    got = seen.get
    return Fingerprint(int(got["rows"]), int(got["digest"]))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> int | None:
    """K1: JSON Lines; null fields are omitted, like the reference's records."""
    return write(df, path, fmt="json", mode=mode)


def save_table(df: DataFrame, name: str, *, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None, path: str | None = None) -> None:
    """A named table in the session catalog, optionally bucketed so
    later joins on the bucket key co-locate without a shuffle; ``path`` makes
    it an external table at that location."""
    w = df.write.format(fmt).mode(mode)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


# ---------------------------------------------------------------- versions

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _number(folder: str) -> int:
    return int(folder[2:].split("-")[0])


def committed_folders(spark: SparkSession, base: str) -> list[str]:
    """Version folders ``v=<n>[-<tag>]`` under ``base`` whose write committed, by
    number (driver metadata listing only; no data is read)."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(name)
    return sorted(out, key=_number)


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Version numbers under ``base`` whose write committed."""
    return [_number(name) for name in committed_folders(spark, base)]


def current_path(spark: SparkSession, base: str) -> str | None:
    v = committed_folders(spark, base)
    return f"{base.rstrip('/')}/{v[-1]}" if v else None


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    p = current_path(spark, base)
    return spark.read.format(fmt).load(p) if p else None


def write_version(df: DataFrame, base: str, *, fmt: str = "parquet",
                  partition_by: Sequence[str] | None = None,
                  tag: str | None = None) -> tuple[str, int | None]:
    """Write ``df`` as the next version of ``base``; returns (path, rows).  A
    ``tag`` (of letters, digits and dashes) becomes part of the folder's name and
    so commits together with the data."""
    spark = df.sparkSession
    v = committed_versions(spark, base)
    fs, p, jvm = _fs(spark, base)
    nxt = (v[-1] + 1) if v else 1
    if fs.exists(p):  # skip numbers left by failed attempts
        used = {_number(st.getPath().getName()) for st in fs.listStatus(p)
                if st.getPath().getName().startswith("v=")}
        while nxt in used:
            nxt += 1
    path = f"{base.rstrip('/')}/v={nxt:08d}" + (f"-{tag}" if tag else "")
    rows = write(df, path, fmt=fmt, mode="errorifexists", partition_by=partition_by)
    return path, rows


def expire_partitions(spark: SparkSession, path: str, column: str, ts_col: str, cutoff: str) -> tuple[list[str], int]:
    """I4 on a date-partitioned dataset: drop the partitions that end before ``cutoff``
    by their folders alone, and rewrite only the day the cutoff falls in, without its
    rows before it.  Returns the dropped dates and the rows left on that day.

    Days after the cutoff are neither listed in depth nor read.  A run that is repeated
    finds nothing more to drop.  As for compaction, expire closed days only."""
    from strata.session import scratch_path
    fs, root, jvm = _fs(spark, path)
    day, prefix = cutoff[:10], f"{column}="
    dates = sorted(st.getPath().getName().removeprefix(prefix) for st in fs.listStatus(root)
                   if st.isDirectory() and st.getPath().getName().startswith(prefix))
    left = 0
    if day in dates and cutoff[10:].strip(" T:0"):   # at midnight the day itself is whole
        part = f"{path.rstrip('/')}/{prefix}{day}"
        stage = scratch_path(spark, "expire")
        keep = spark.read.parquet(part).filter(F.col(ts_col) >= F.lit(cutoff.replace("T", " ")).cast("timestamp_ntz"))
        left = write(keep, stage)
        if left:
            write(spark.read.parquet(stage), part)
        else:
            fs.delete(jvm.org.apache.hadoop.fs.Path(part), True)
    gone = [d for d in dates if d < day and len(d) == 10]
    for d in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, prefix + d), True)
    return gone, left


def compact_partition(spark: SparkSession, path: str, column: str, value, *,
                      target_bytes: int = 128 * 1024 * 1024) -> int:
    """Rewrite one partition of an append-only, partitioned dataset (a log
    ``date``) as few files of about ``target_bytes``; returns the file count.

    The partition's rows are first copied to a scratch folder, then the
    partition is replaced from that copy with a dynamic partition overwrite,
    so no job reads and writes the same files.  Compact only *closed*
    partitions (rows appended between the two steps would be lost).
    """
    import math

    from strata.session import scratch_path
    fs, p, jvm = _fs(spark, f"{path.rstrip('/')}/{column}={value}")
    if not fs.exists(p):
        return 0
    size = int(fs.getContentSummary(p).getLength())
    n = max(1, math.ceil(size / target_bytes))
    stage = scratch_path(spark, "compact")
    part = spark.read.parquet(path).filter(F.col(column) == F.lit(value))
    part.coalesce(n).write.parquet(stage)
    (spark.read.parquet(stage).repartition(n).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    sfs, sp, _ = _fs(spark, stage)
    sfs.delete(sp, True)
    return n
