"""Data-quality checks, gates, quarantine and layer reconciliation
(A4-A8, A11, Q1-Q14, U3, U4).

All checks of a table are one aggregate pass that returns a DataFrame; only the gates
pull a single summary row to the driver to decide whether to raise.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import not_blank, safe_ratio
from strata.sinks.writers import Fingerprint

# The email pattern and thresholds the reference documents.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
MIN_QUALITY_SCORE = 0.85
MAX_NULL_RATE = 0.05

class QualityGateError(ValueError):
    """Raised by a gate; the pipeline records the failure and re-raises."""


# ---------------------------------------------------------------- counts

def retention_report(bronze: DataFrame, key: str) -> DataFrame:
    """A4 + A6 + A7 in one pass over bronze.

    keep-first silver holds one row per distinct non-blank key, so its size is
    ``count(distinct key)`` over the non-blank rows: no second scan.
    """
    ok = not_blank(key)
    agg = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"),
                     F.count_if(ok).alias("ids_present"),
                     F.count_if(~F.coalesce(ok, F.lit(False))).alias("ids_blank"),
                     F.count_distinct(F.when(ok, F.col(key))).alias("silver_rows"))
    return agg.select("*", (F.col("ids_present") - F.col("silver_rows")).alias("duplicates"),
                      F.round(safe_ratio("silver_rows", "bronze_rows"), 6).alias("retention"))


def layer_ratio(n_silver: Column, n_bronze: Column) -> Column:
    """Silver / bronze, 0 when bronze is empty."""
    return safe_ratio(n_silver, n_bronze)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5 / Q3: nulls of every column in ONE scan, returned long:
    ``(column_name, row_count, null_count, null_rate)``."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `_null_{i}`" for i, c in enumerate(cols))
    long = wide.selectExpr("_n AS row_count", f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")
    return long.select("column_name", "row_count", "null_count",
                       F.round(safe_ratio("null_count", "row_count"), 6).alias("null_rate"))


def table_report(df: DataFrame, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3: :func:`null_profile` with the size of the table's files in MB, from their
    listing (file contents are read once, for the nulls)."""
    from strata.sources.files import list_files
    size = list_files(df.sparkSession, path).agg(F.round(F.sum("length") / F.lit(1048576.0), 2).alias("size_mb"))
    return null_profile(df, cols).withColumn("size_mb", size.scalar())


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, rsd: float = 0.02) -> DataFrame:
    """Q12: one pass: nulls, min, max (as text) and approximate distinct count
    (HyperLogLog++, bounded memory per column however large the table)."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_z{i}"),
                 F.min(F.col(c)).cast("string").alias(f"_lo{i}"),
                 F.max(F.col(c)).cast("string").alias(f"_hi{i}"),
                 F.approx_count_distinct(F.col(c), rsd).alias(f"_d{i}")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', `_z{i}`, `_lo{i}`, `_hi{i}`, `_d{i}`" for i, c in enumerate(cols))
    return wide.selectExpr("_n AS row_count",
                           f"stack({len(cols)}, {rows}) AS (column_name, null_count, min_value, "
                           "max_value, approx_distinct)")


def null_rate(df: DataFrame, col: str) -> DataFrame:
    """Share of nulls in one column (one row)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_if(F.col(col).isNull()).alias("null_count")).select(
        "row_count", "null_count", F.round(safe_ratio("null_count", "row_count"), 6).alias("null_rate"))


# ---------------------------------------------------------------- gates

def null_rate_gate(df: DataFrame, col: str, max_rate: float = MAX_NULL_RATE) -> DataFrame:
    """Q4 report: null rate of ``col`` and whether it is within ``max_rate``."""
    return null_rate(df, col).select(F.lit(col).alias("column_name"), "*",
                                     F.lit(max_rate).alias("threshold"),
                                     (F.col("null_rate") <= max_rate).alias("passed"))


def score_gate(report: DataFrame, min_score: float = MIN_QUALITY_SCORE,
               score_col: str = "retention") -> DataFrame:
    """Q5 report: quality score against the minimum."""
    return report.select(F.col(score_col).alias("score"), F.lit(min_score).alias("threshold"),
                         (F.col(score_col) >= min_score).alias("passed"))


def enforce(gate_report: DataFrame, what: str = "quality gate") -> dict:
    """Raise :class:`QualityGateError` when the one-row gate report failed."""
    row = gate_report.first()
    d = row.asDict() if row else {}
    if not d.get("passed", False):
        raise QualityGateError(f"{what} failed: {d}")
    return d


# ---------------------------------------------------------------- check rows

@dataclass(frozen=True)
class Check:
    """One check of a table: aggregates of the rows that pass and fail, and the
    status when any fails."""
    name: str
    type: str
    passed: Column
    failed: Column
    on_failure: str = "failed"
    details: dict | None = None


def run_checks(df: DataFrame, table_name: str, checks: Sequence[Check], *, details: bool = False) -> DataFrame:
    """One result row per check, all checks of a table in ONE scan
    (error rate 0 when nothing was checked).  With ``details`` each row says as JSON
    what its check looked at."""
    aggs = [c.alias(f"_{k}{i}") for i, x in enumerate(checks) for k, c in (("p", x.passed), ("f", x.failed))]
    cells = [v for i, x in enumerate(checks)
             for v in (F.lit(x.name), F.lit(x.type), F.lit(x.on_failure), F.col(f"_p{i}"), F.col(f"_f{i}"),
                       F.lit(json.dumps(x.details) if x.details else None).cast("string"))]
    rows = df.agg(*aggs).select(F.stack(F.lit(len(checks)), *cells).alias(
        "check_name", "check_type", "on_failure", "p", "f", "details"))
    status = F.when(F.col("f") == 0, "passed").otherwise(F.col("on_failure"))
    return rows.select(F.lit(table_name).alias("table_name"), "check_name", "check_type", status.alias("status"),
                       F.col("p").cast("long").alias("passed_count"), F.col("f").cast("long").alias("failed_count"),
                       F.round(safe_ratio("f", F.col("p") + F.col("f")), 6).alias("error_rate"),
                       *(["details"] if details else []))


def _row_check(name: str, check_type: str, ok: Column, on_failure: str = "failed", **details) -> Check:
    ok = F.coalesce(ok, F.lit(False))
    return Check(name, check_type, F.count_if(ok), F.count_if(~ok), on_failure, details or None)


def completeness(key: str) -> Check:
    """Q1: rows with a usable key pass; any blank key makes it a *warning*."""
    return _row_check(f"{key}_completeness", "completeness", not_blank(key), "warning", column=key)


def uniqueness(key: str) -> Check:
    """Q2: always *passed*; failed = duplicates removed by keep-first."""
    ok = not_blank(key)
    keys = F.count_distinct(F.when(ok, F.col(key)))
    return Check("deduplication", "uniqueness", keys, F.count_if(ok) - keys, "passed", {"column": key, "kept": "first"})


def pattern(col: str, regex: str = EMAIL_PATTERN, name: str | None = None) -> Check:
    """Q6: values matching the pattern pass; null or non-matching fail."""
    return _row_check(name or f"{col}_format", "validity", F.col(col).rlike(regex), column=col, pattern=regex)


def accepted_values(col: str, accepted: Sequence[str]) -> Check:
    """Q7: values in the accepted set pass; null and others fail."""
    return _row_check(f"{col}_accepted_values", "accepted_values", F.col(col).isin(list(accepted)), column=col,
                      accepted=list(accepted))


def referential_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                      table_name: str) -> DataFrame:
    """Q8: child rows whose key has no parent fail.

    One pass over the child: a left join to the distinct parent keys flags
    each row (parent keys are unique after ``distinct``, so no fan-out)."""
    pk = parent.select(F.col(parent_key).alias("_pk")).distinct()
    flagged = child.join(pk, child[child_key] == pk["_pk"], "left")
    return run_checks(flagged, table_name, [_row_check(f"{child_key}_references_{parent_key}", "referential",
                                                       F.col("_pk").isNotNull(), column=child_key, parent=parent_key)])


def orphans_of(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent (``left_anti``)."""
    return child.join(parent.select(F.col(parent_key).alias("_pk")),
                      child[child_key] == F.col("_pk"), "left_anti")


# ---------------------------------------------------------------- quarantine, flags

def quarantine(df: DataFrame, rules: dict[str, Column], rules_col: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """Q9: split rows into (clean, quarantined); quarantined rows carry the
    sorted names of the rules they break.  ``rules`` maps name -> *failure*
    condition (null counts as not failed)."""
    names = sorted(rules)
    failed = F.array_compact(F.array(*[F.when(F.coalesce(rules[n], F.lit(False)), F.lit(n))
                                       for n in names]))
    tagged = df.withColumn(rules_col, failed)
    return (tagged.filter(F.size(rules_col) == 0).drop(rules_col),
            tagged.filter(F.size(rules_col) > 0))


def flag_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Q14: share of rows raising each 0/1 flag."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.round(F.avg(F.col(f).cast("double")), 6).alias(f"{f}_rate") for f in flags])


# ---------------------------------------------------------------- reconciliation

def one_row(parts: list[DataFrame]) -> DataFrame:
    """Several one-row aggregates as one row with all their columns, without a join."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def reconcile_writes(spark, checks: Sequence[tuple[str, Fingerprint, Fingerprint]]) -> DataFrame:
    """Q10 / U3 / U4 from the writes: ``(check_name, source, target)`` fingerprints as
    check rows.  A lost or doubled row changes the count, a changed row the digest.  The
    layers themselves are not read."""
    rows = [(name, "reconciliation", "passed" if a == b else "failed", a.rows, b.rows,
             "equal" if a == b else "rows differ" if a.rows != b.rows else "contents differ") for name, a, b in checks]
    return spark.createDataFrame(rows, "check_name string, check_type string, status string, source_rows long, "
                                       "target_rows long, details string").coalesce(1)


def reconcile(bronze: DataFrame, silver: DataFrame, gold: DataFrame, members: DataFrame,
              key: str = "id", count_col: str = "count") -> DataFrame:
    """U3 + U4: one row of layer invariants.

    * ``missing_in_gold`` / ``extra_in_gold``: silver keys not in the gold
      member table and vice versa, as multisets;
    * ``conserved``: sum(gold.count) = silver rows = member rows <= bronze rows.

    The key comparison is one shuffle: silver keys tagged (1, 0) and member
    keys tagged (0, 1) are summed per key (partially aggregated, so a key
    repeated many times costs one row per map task); the surplus on either
    side counts as missing or extra.  Row counts fall out of the same pass.
    """
    tagged = (silver.select(F.col(key).alias("_k"), F.lit(1).alias("_s"), F.lit(0).alias("_m"))
              .unionByName(members.select(F.col(key).alias("_k"), F.lit(0).alias("_s"),
                                          F.lit(1).alias("_m"))))
    per_key = tagged.groupBy("_k").agg(F.sum("_s").alias("_s"), F.sum("_m").alias("_m"))
    ids = per_key.agg(F.sum("_s").cast("long").alias("silver_rows"),
                      F.sum("_m").cast("long").alias("member_rows"),
                      F.sum(F.greatest(F.col("_s") - F.col("_m"), F.lit(0))).cast("long").alias("missing_in_gold"),
                      F.sum(F.greatest(F.col("_m") - F.col("_s"), F.lit(0))).cast("long").alias("extra_in_gold"))
    counts = [bronze.agg(F.count(F.lit(1)).alias("bronze_rows")),
              gold.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("long").alias("gold_total"),
                       F.count(F.lit(1)).alias("gold_groups")),
              ids]
    out = one_row(counts).select("bronze_rows", F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"),
                                 "gold_total", "gold_groups",
                                 F.coalesce("member_rows", F.lit(0)).alias("member_rows"),
                                 F.coalesce("missing_in_gold", F.lit(0)).alias("missing_in_gold"),
                                 F.coalesce("extra_in_gold", F.lit(0)).alias("extra_in_gold"))
    ok = ((F.col("gold_total") == F.col("silver_rows")) & (F.col("member_rows") == F.col("silver_rows"))
          & (F.col("silver_rows") <= F.col("bronze_rows")) & (F.col("missing_in_gold") == 0)
          & (F.col("extra_in_gold") == 0))
    return out.withColumn("conserved", ok)


def pii_scan(df: DataFrame, cols: Sequence[str], patterns: dict[str, str],
             required: dict[str, str] | None = None) -> DataFrame:
    """Q13: per column and pattern, how many rows contain a match (whole
    texts are scanned; one pass for all columns and patterns).

    ``required`` maps a pattern name to a literal every match contains (such
    as ``'@'`` for e-mail addresses): a cheap substring test then skips the
    regular expression on texts that cannot match.  The result is the same.
    """
    required = required or {}
    aggs = [F.count(F.lit(1)).alias("_n")]
    keys = []
    for i, c in enumerate(cols):
        for j, (name, pat) in enumerate(patterns.items()):
            hit = F.col(c).rlike(pat)
            if name in required:
                hit = F.col(c).contains(required[name]) & hit
            aggs.append(F.count_if(F.coalesce(hit, F.lit(False))).alias(f"_m{i}_{j}"))
            keys.append((c, name, f"_m{i}_{j}"))
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', '{n}', `{a}`" for c, n, a in keys)
    long = wide.selectExpr("_n AS row_count",
                           f"stack({len(keys)}, {rows}) AS (column_name, pii_type, matching_rows)")
    return long.select("column_name", "pii_type", "row_count", "matching_rows",
                       F.round(safe_ratio("matching_rows", "row_count"), 6).alias("match_rate"))
