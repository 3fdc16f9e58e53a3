"""Shared helpers of the training-data operators.

Word rule of every operator: words are maximal runs of characters other than
space and the five ASCII control blanks (``[^\\x20\\x09-\\x0D]+``); lower-casing
touches A-Z only.  Both rules work on UTF-8 bytes, so whole Arrow string
buffers are hashed with numpy and no Python string is built.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: Bytes of text handled at once inside a task; a longer single text is its own slice.
SLICE_BYTES = 2 << 20

_U = np.uint64
_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an unsigned array."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _byte_table(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {True: _byte_table(True), False: _byte_table(False)}
_P = 0x9E3779B97F4A7C55
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = n if n > SLICE_BYTES + 1 else 1 << n.bit_length()
        with np.errstate(over="ignore"):
            for k, base in (("p", _P), ("i", _P_INV)):
                a = np.full(size, base, _U)
                a[0] = 1
                np.multiply.accumulate(a, out=a)
                _POWERS[k] = a
    out = _POWERS["p"][:n], _POWERS["i"][:n]
    if n > SLICE_BYTES + 1:  # do not keep what one very long text needed
        _POWERS.clear()
    return out


class Words:
    """The words of a slice of texts: ``hash`` (64 bits each), byte ``start`` and
    ``end`` in ``buf``, and ``first[i]:first[i+1]`` as the words of text i."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        solid = ~_WS[buf]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if n else np.zeros(0, bool)
        after = np.concatenate([solid[1:], [False]]) if n else np.zeros(0, bool)
        self.start = np.flatnonzero(solid & (~before | edge[:n]))
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        p, inv = _powers(n + 1)
        acc = np.zeros(n + 1, _U)
        np.cumsum(_TABLES[lower][buf] * p[:n], out=acc[1:])
        length = (self.end - self.start).astype(_U)
        self.hash = mix((acc[self.end] - acc[self.start]) * inv[self.start] + length)
        self.first = np.searchsorted(self.start, offsets)

    def text(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut an Arrow batch into runs of rows of at most ``max_bytes`` text (or one
    row), each with the text bytes and offsets; a null text counts as empty."""
    col = batch.column(column)
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    raw = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(raw, raw[at] + max_bytes, "right")) - 1)
        to = min(to, n)
        yield batch.slice(at, to - at), data[raw[at]:raw[to]], raw[at:to + 1] - raw[at]
        at = to


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts
    lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete what ``keep_table`` wrote for ``df``, which nothing reads any more."""
    path = vars(df).get("_kept_path")
    if path is not None:
        sc = df.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Within it, a job's shuffle files go as soon as it ends: for jobs whose results are
    kept as tables.  The session's own setting is put back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Within it, jobs hand Python workers at most ``rows`` rows at a time: for rows
    that carry whole sets.  The session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column starts with it."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name


def remainder(doc_id: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def word_array(text):
    """The words of a text column as an array (null text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on them
    (no-op if PYTHONPATH already names it, or once it is shipped)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_strata_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "strata"))
    sc._strata_shipped = True
