"""Cleaning, validation and deduplication.

Deduplication uses aggregates (``min_by`` / ``max_by``) rather than windows:
the partial aggregate combines duplicates on the map side, so a key holding a
third of all rows still reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import digits_only, not_blank

# ---------------------------------------------------------------- filters


def require_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key fields are non-null and not whitespace only."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & not_blank(k)
    return df.filter(cond)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P5 (subset) / P6 (any column): drop rows with a null."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Conjunctive not-null filter."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


# ---------------------------------------------------------------- dedup


def _orderable(t: T.DataType) -> bool:
    """Maps (and what holds them) have no order."""
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def _best_row(df: DataFrame, order: list[str], rest: list[str], largest: bool) -> Column:
    """The row with the smallest / largest ``order`` tuple, as an aggregate.
    Columns without an order ride along and break no ties."""
    row = F.struct(*[F.col(c) for c in order + rest])
    plain = [c for c in rest if _orderable(df.schema[c].dataType)]
    if len(plain) == len(rest):
        return F.max(row) if largest else F.min(row)
    rank = F.struct(*[F.col(c) for c in order + plain])
    return F.max_by(row, rank) if largest else F.min_by(row, rank)


def _pick(df: DataFrame, keys: list[str], order: list[str], largest: bool) -> DataFrame:
    """Per key, the row with the smallest / largest ``order`` tuple.

    ``min``/``max`` over one struct that starts with the ordering columns and
    carries the rest of the row: the struct order is the row order, and the
    partial aggregate collapses each key on the map side before the shuffle.
    Remaining ties are broken by the other columns, so the pick is
    deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(_best_row(df, order, rest, largest).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in order + rest]).select(*df.columns)


def keep_first(df: DataFrame, key: str | Sequence[str], order_col: str = "_ord") -> DataFrame:
    """First row per key in ``order_col`` order (the key is not trimmed).

    Rows whose key is null form one group, as in a dict keyed by the value;
    callers drop them first with :func:`require_keys`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return _pick(df, keys, [order_col], largest=False)


def keep_first_with_count(df: DataFrame, key: str | Sequence[str],
                          order_col: str = "_ord") -> DataFrame:
    """D1 plus ``_copies``: how many rows shared the key (duplicates + 1)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    picked = df.groupBy(*keys).agg(_best_row(df, [order_col], rest, largest=False).alias("_row"),
                                   F.count(F.lit(1)).alias("_copies"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in [order_col] + rest], "_copies")


def keep_latest(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str],
                tiebreak: Sequence[str] | str = "all") -> DataFrame:
    """The latest row per key: greatest ``order_by`` tuple.

    Ties are broken by the remaining columns (``'all'``) or the given ones
    first, so the answer is deterministic even when rows share the
    timestamp.  Equal to ``row_number() over (partition by key order by ..
    desc) = 1`` without sorting a whole key group in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_by = list(order_by)
    if tiebreak == "all":  # the columns that _pick falls back to
        tiebreak = []
    return _pick(df, keys, order_by + [c for c in tiebreak if c not in order_by], largest=True)


def distinct_rows(df: DataFrame, exclude_prefix: str = "_") -> DataFrame:
    """Whole-row distinct on the data columns.

    Provenance columns (``_`` prefix) differ between batches and would keep
    every copy, so they are ignored for the comparison (first-seen copy kept
    arbitrarily, as ``dropDuplicates`` does).
    """
    cols = [c for c in df.columns if not c.startswith(exclude_prefix)] if exclude_prefix else df.columns
    return df.dropDuplicates(cols)


# ---------------------------------------------------------------- normalise

ACCEPTED_STATUS = ("active", "inactive", "suspended")


def conform_domain(c, accepted: Sequence[str], other: str = "unknown") -> Column:
    """Keep values in the accepted set, else ``other`` (null -> other)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(list(accepted)), c).otherwise(F.lit(other))


def quality_flags(email: str = "email", phone: str = "phone", min_phone_digits: int = 10) -> dict:
    """0/1 data-quality flags computed on the raw values.

    ``''`` email is both missing and invalid; a null email is missing but not
    invalid (``NULL NOT LIKE`` is not true).
    """
    e, p = F.col(email), F.col(phone)
    return {
        "missing_email_flag": F.when(e.isNull() | (e == ""), 1).otherwise(0),
        "invalid_email_flag": F.when(~e.like("%@%"), 1).otherwise(0),
        "invalid_phone_flag": F.when(p.isNull() | (F.length(digits_only(p)) < min_phone_digits), 1)
                               .otherwise(0),
    }


def normalise_contacts(df: DataFrame, *, key: str = "customer_id",
                       accepted_status: Sequence[str] = ACCEPTED_STATUS,
                       processed_ts: Column | None = None) -> DataFrame:
    """P15 + P11 + P12 + P7: the silver contact model as one projection.

    Text columns that are absent from the input are skipped.
    """
    have = set(df.columns)
    out: list[Column] = [F.col(key)]

    def add(name, expr, needs):
        if needs in have:
            out.append(expr.alias(name))

    add("customer_name", F.trim(F.upper(F.col("customer_name"))), "customer_name")
    add("email", F.lower(F.trim(F.col("email"))), "email")
    add("phone_normalized", digits_only(F.col("phone")), "phone")
    for c in ("address", "city"):
        add(c, F.trim(F.col(c)), c)
    for c in ("state", "country"):
        add(c, F.upper(F.trim(F.col(c))), c)
    for c in ("postal_code", "registration_date"):
        add(c, F.col(c), c)
    add("status", conform_domain("status", accepted_status), "status")
    for c in ("source_system", "ingestion_timestamp"):
        add(c, F.col(c), c)
    if processed_ts is not None:
        out.append(processed_ts.alias("processed_timestamp"))
    if "email" in have and "phone" in have:
        out += [v.alias(k) for k, v in quality_flags().items()]
    req = [key] + (["customer_name"] if "customer_name" in have else [])
    return require_not_null(df, req).select(*out)


def conform_types(df: DataFrame, casts: dict[str, str], renames: dict[str, str] | None = None,
                  error_col: str = "_cast_errors") -> DataFrame:
    """``try_cast`` to target types + standard names.

    A value that is present but does not convert becomes null and its column
    name is listed in ``error_col`` (for quarantine, Q9).
    """
    renames = renames or {}
    errs = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
            for c, t in casts.items()]
    out = df.withColumn(error_col, F.array_compact(F.array(*errs)) if errs else F.array())
    out = out.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})
    return out.withColumnsRenamed(renames) if renames else out
