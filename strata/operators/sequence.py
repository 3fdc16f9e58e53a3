"""Previous / next row of the same key in time order, without one task per key.

``lag``/``lead`` over ``Window.partitionBy(key)`` sends every row of a key to one
task; when one key holds a third of the data, that task is the job.  Here the order
of a heavy key is cut into ranges, and the rows at range ends are completed by a
carry, in one path for all keys:

1. :func:`ranges_of` draws a bounded sample of (key, time, tiebreak) and cuts the
   order of each key that holds more than ``rows_per_range`` rows at the sample's
   quantiles.  Cuts are points of the order itself (time, tiebreak and, last, a hash
   of the row), so a burst within one second is cut like any other stretch; only rows
   equal in every column stay together.  There are at most about 2 x rows /
   ``rows_per_range`` cuts; keys below that have none.
2. The window runs per (key, range): one shuffle of the rows.
3. Each range of a cut key hands its first (or last) row on: a partial aggregate of
   the cut keys' rows, one row per range.  ``lag``/``lead`` over these few rows gives
   the neighbouring range's edge, also across empty ranges.
4. The carry is joined back to the edge rows; it is as small as the list of cuts.

Without a heavy key there is no cut and the plan is the plain window.  The cuts are
literals of the plan, so a lost task that runs again cuts alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key that one task is meant to hold.
ROWS_PER_RANGE = 1_000_000
#: Rows of the sample per range that all rows would make (bounds the driver's share).
SAMPLE_PER_RANGE, SAMPLE_MIN, SAMPLE_MAX = 40, 4_000, 400_000

_R = "_range"


@dataclass
class Ranges:
    """Cuts of the order of heavy keys: ``cuts(key..., points)``, None without any."""
    keys: list[str]
    order: list[str]
    cuts: DataFrame | None


def _point(df_columns: Sequence[str], order: Sequence[str]) -> Column:
    """A row's place in the order; the hash of the row parts rows that tie in it."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                    F.xxhash64(*[F.col(c) for c in df_columns]).alias("h"))


def ranges_of(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (),
              rows_per_range: int = ROWS_PER_RANGE) -> Ranges:
    """Where the order of the heavy keys is cut (see the module docstring).  Reads the
    rows' count and, if a key can be heavy at all, one sample; reuse the result for
    every pass over the same rows or a part of them."""
    keys, order = list(keys), [ts, *tiebreak]
    none = Ranges(keys, order, None)
    n = df.count()
    if n <= rows_per_range:
        return none
    want = min(SAMPLE_MAX, max(SAMPLE_MIN, SAMPLE_PER_RANGE * -(-n // rows_per_range)))
    share = min(1.0, want / n)
    drawn = df.select(*keys, *[c for c in order if c not in keys]) if share >= 1 else df.sample(share, seed=7)
    # per key of the sample its points in order; about `want` rows in all, whatever the table's size
    weight = rows_per_range * share
    per_key = (drawn.select(*keys, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                                            F.xxhash64(F.rand(7)).alias("h")).alias("p"))
               .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("p")).alias("p"))
               .where(F.col("n") > F.lit(weight)))
    parts = F.ceil(F.col("n") / F.lit(weight))
    at = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("p", F.floor(i * F.col("n") / parts).cast("int")))
    rows = per_key.select(*keys, F.array_distinct(at).alias("points")).toArrow()
    if rows.num_rows == 0:
        return none
    cuts = df.sparkSession.createDataFrame(rows, schema=per_key.select(*keys, F.array_distinct(at).alias("points")).schema)
    return Ranges(keys, order, cuts)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equi-join in which null keys (and null times) match each other, as
    they do in a window."""
    names = {k: f"_seq_k{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    on = F.lit(True)
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def with_range(df: DataFrame, ranges: Ranges) -> DataFrame:
    """The rows with the number of their range (0 for keys that are not cut)."""
    if ranges.cuts is None:
        return df.withColumn(_R, F.lit(0))
    point = _point(df.columns, ranges.order)
    # the list of cuts is bounded by the sample it was taken from, so it is broadcast
    x = _null_safe(df, F.broadcast(ranges.cuts), ranges.keys, "left")
    return (x.withColumn(_R, F.coalesce(F.size(F.filter("points", lambda p: p <= point)), F.lit(0)))
            .drop("points"))


def _neighbour(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], value: str, out_col: str,
               forward: bool, ranges: Ranges | None, rows_per_range: int | None, plain: bool) -> DataFrame:
    keys, order = list(keys), [ts, *tiebreak]
    shift = F.lead if forward else F.lag
    if ranges is None and not plain:
        ranges = ranges_of(df, keys, ts, tiebreak, rows_per_range or ROWS_PER_RANGE)
    if ranges is None or ranges.cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out_col, shift(F.col(value), 1).over(w))
    x = with_range(df, ranges)
    # rows that tie in the order stand by their hash, within a range as between ranges
    inner = Window.partitionBy(*keys, _R).orderBy(*order, F.xxhash64(*[F.col(c) for c in df.columns]))
    first = F.struct(F.lit(1).alias("there"), F.col(value).alias("v"))
    y = x.withColumn("_seq_in", shift(first, 1).over(inner))
    point = _point(df.columns, order)
    edge = F.min_by(F.col(value), point) if forward else F.max_by(F.col(value), point)
    cut = _null_safe(x, F.broadcast(ranges.cuts.select(*keys)), keys, "left_semi")
    carry = cut.groupBy(*keys, _R).agg(edge.alias("_seq_v"))
    outer = Window.partitionBy(*keys).orderBy(_R)   # at most one row per range
    carry = carry.select(*keys, _R, shift("_seq_v", 1).over(outer).alias("_seq_carry"))
    joined = _null_safe(y, carry, [*keys, _R], "left")
    return (joined.withColumn(out_col, F.when(F.col("_seq_in").isNotNull(), F.col("_seq_in.v"))
                              .otherwise(F.col("_seq_carry")))
            .drop(_R, "_seq_in", "_seq_carry"))


def next_in_sequence(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (),
                     *, value: str | None = None, out_col: str = "next_ts", ranges: Ranges | None = None,
                     bucket: str | None = "auto", hot_rows: int | None = ROWS_PER_RANGE) -> DataFrame:
    """``lead(value)`` per key in ``(ts, tiebreak)`` order (value defaults to ts).

    ``hot_rows``: rows of one key that one task is meant to hold; ``ranges`` reuses
    the cuts of an earlier call; ``bucket=None`` gives the plain window."""
    return _neighbour(df, keys, ts, list(tiebreak), value or ts, out_col, True, ranges, hot_rows, bucket is None)


def previous_in_sequence(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (),
                         *, value: str | None = None, out_col: str = "prev_value", ranges: Ranges | None = None,
                         bucket: str | None = "auto", hot_rows: int | None = ROWS_PER_RANGE) -> DataFrame:
    """``lag(value)`` per key in ``(ts, tiebreak)`` order (see ``next_in_sequence``)."""
    return _neighbour(df, keys, ts, list(tiebreak), value or ts, out_col, False, ranges, hot_rows, bucket is None)
