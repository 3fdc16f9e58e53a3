"""The query catalogue: each entry runs one operator group over whole tables
of a scale-factor folder, paired with an independent DuckDB oracle.

Conventions shared by both sides of every pair:
* computed columns carry the same alias;
* doubles are rounded (ratios to 6 places, money sums to 2);
* timestamps produced by a query are rendered as ``yyyy-MM-dd HH:mm:ss`` text;
* lists are rendered as delimited text in a fully determined order;
* ``as_of`` is pinned to 2024-01-31 00:00:00 (events span January 2024).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import fixtures as fx
from strata.plans.medallion import medallion

AS_OF = "2024-01-31 00:00:00"

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from strata.plans import q_alerts, q_governance, q_monitoring, q_silver_gold, q_streaming  # noqa: F401


# ---------------------------------------------------------------- shared plans

def f1_layers(spark: SparkSession, sf_dir: str):
    return medallion(fx.messy_orders(spark, sf_dir), key="id", group_by="prio", order_col="ord")


F1_SILVER_SQL = fx.F1_SQL + """,
silver AS (
  SELECT * FROM f1
  WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)"""


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
