"""Scalar column expressions used across the operators.

All of these compile to JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode whitespace, Spark's trim() only spaces.
# "(?U)\S" = at least one character that is not Unicode whitespace.
_NON_BLANK = r"(?U)\S"

ISO_SECONDS = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_blank(c) -> Column:
    """True when the value is non-null and has a non-whitespace character."""
    c = _c(c)
    return c.isNotNull() & c.rlike(_NON_BLANK)


def blank(c) -> Column:
    """Null, empty or whitespace only (the complement of :func:`not_blank`)."""
    return ~F.coalesce(not_blank(c), F.lit(False))


def safe_ratio(num, den) -> Column:
    """num/den, 0.0 when den is zero or null (ANSI-safe)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def seconds_to_ms(c) -> Column:
    """Seconds (double) to whole milliseconds, truncating; 0 or null -> null."""
    c = _c(c)
    return F.when(c.isNull() | (c == 0), F.lit(None).cast("long")).otherwise((c * 1000).cast("long"))


def digits_only(c) -> Column:
    """Remove every non-digit character (all occurrences)."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def file_stem(path) -> Column:
    """File name without folder and last extension: '/a/b/x.csv' -> 'x'."""
    return F.regexp_extract(_c(path), r"([^/]+?)(\.[^./]*)?$", 1)


def json_text(fields: dict[str, Column]) -> Column:
    """named columns as one JSON object (null fields are left out)."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def json_fields(c, schema: str) -> Column:
    """a JSON object column as a struct of ``schema``; text that is not JSON gives
    nulls."""
    return F.from_json(_c(c), schema)


def ts_text(c, fmt: str = ISO_SECONDS) -> Column:
    """Timestamp as text (used only for export and engine-neutral compares)."""
    return F.date_format(_c(c), fmt)


def as_of_ts(as_of) -> Column:
    """A fixed instant for time-dependent operators, else the query time."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def epoch_seconds(c) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` (floor for
    positive instants), independent of the session time zone."""
    c = _c(c).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
