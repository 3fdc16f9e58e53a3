"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from strata.functions.scalar import (  # noqa: F401
    as_of_ts,
    blank,
    digits_only,
    epoch_seconds,
    file_stem,
    json_fields,
    json_text,
    not_blank,
    safe_ratio,
    seconds_to_ms,
    ts_text,
)
