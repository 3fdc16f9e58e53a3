"""Business aggregates for the gold layer.

Group member lists are kept as a long table ``(group, member, order)`` rather
than one array per group: a group can hold a third of all rows, and an array
of that size would have to sit in one task and one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def group_key(key: str, missing: str = UNKNOWN) -> Column:
    """A null (absent) group value becomes ``missing``; ``''`` stays ``''``."""
    return F.coalesce(F.col(key), F.lit(missing)).alias(key)


def group_count(df: DataFrame, key: str, *, missing: str | None = UNKNOWN,
                count_col: str = "count") -> DataFrame:
    """A1 (count part) / A2: rows per group, partial aggregation on the map side."""
    k = group_key(key, missing) if missing is not None else F.col(key)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias(count_col))


def group_members(df: DataFrame, key: str, member: str = "id", order_col: str = "_ord",
                  *, missing: str = UNKNOWN) -> DataFrame:
    """A1 (member part): one row per member with its group and its order.

    A pure projection (no shuffle); sort by ``order_col`` within a group to get
    the reference's list order.
    """
    return df.select(group_key(key, missing), F.col(member), F.col(order_col))


def members_array(df: DataFrame, key: str, member: str = "id", order_col: str = "_ord",
                  *, missing: str = UNKNOWN, max_members: int = 100_000) -> DataFrame:
    """A1 in the reference's shape: ``(key, count, records array)``.

    Only for groups of a checked, bounded size: raises when any group has more
    than ``max_members`` members instead of building an unbounded array (use
    :func:`group_members` then).  Nothing is truncated.
    """
    counts = group_count(df, key, missing=missing)
    biggest = counts.agg(F.max("count")).first()[0] or 0
    if biggest > max_members:
        raise ValueError(f"group of {biggest} members exceeds max_members={max_members}; "
                         "use group_members() for the long form")
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                 F.col(member).alias("m"))))
    return (df.groupBy(group_key(key, missing))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.transform(pairs, lambda x: x["m"]).alias("records")))


def top_groups(df: DataFrame, key: str, k: int | None = None, *,
               count_col: str = "count") -> DataFrame:
    """A3 / L3: groups by count descending (ties by key), optionally the top k."""
    out = group_count(df, key, missing=None, count_col=count_col).orderBy(
        F.col(count_col).desc(), F.col(key).asc_nulls_last())
    return out.limit(k) if k else out


# ---------------------------------------------------------------- star schema


def enrich_sales(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                 nation: DataFrame, region: DataFrame) -> DataFrame:
    """Fact rows with customer, nation and region attributes.

    The two big sides (lineitem, orders) join by shuffle on the order key; the
    dimension chain customer -> nation -> region is left to the optimizer,
    which broadcasts only what its size statistics prove small (AQE re-plans
    at runtime from real sizes).  nation/region have fixed cardinality.
    """
    dims = (customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey")),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(F.broadcast(region.select("r_regionkey", "r_name")),
                  F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    li = lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount",
                         "l_returnflag")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
            .join(dims, F.col("o_custkey") == F.col("c_custkey"), "left")
            .withColumn("revenue", revenue_expr()))


def revenue_expr() -> Column:
    """Line revenue, exactly, as a long count of 1e-4 currency units.

    Money arrives as double with two decimals.  Summing doubles depends on the
    order of addition, so rounded totals could differ between runs and
    engines.  Cents and discount percent are exact integers, so their product
    is exact.  Totals are summed as ``decimal(38,0)`` (see :func:`money`),
    which cannot overflow and stays on Spark's long-backed decimal path.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    pct = F.round(F.col("l_discount") * 100).cast("long")
    return cents * (F.lit(100) - pct)


def money(units_sum: Column, scale: int = 10000) -> Column:
    """An exact total of integer ``units`` (``1 / scale`` of a currency unit),
    rounded to cents (half up), as double."""
    return F.round(units_sum / F.lit(scale).cast("decimal(10,0)"), 2).cast("double")


def units_sum(c) -> Column:
    """``sum`` of integer units as ``decimal(38,0)`` (no overflow)."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)"))


def sales_rollup(enriched: DataFrame) -> DataFrame:
    """Revenue with region / nation hierarchy totals (ROLLUP).

    ``level`` is 0 for detail rows, 1 for region totals, 3 for the grand total.
    """
    return (enriched.rollup("r_name", "n_name")
            .agg(money(units_sum("revenue")).alias("revenue"),
                 F.count(F.lit(1)).alias("lines"),
                 F.grouping_id().alias("level")))


def monthly_sales(enriched: DataFrame, dims: Sequence[str] = ("r_name",)) -> DataFrame:
    """Time-bucketed gold (month x dimension): sum, average, count."""
    month = F.date_format(F.date_trunc("month", F.col("o_orderdate")), "yyyy-MM").alias("month")
    return (enriched.groupBy(month, *dims)
            .agg(money(units_sum("revenue")).alias("revenue"),
                 F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
                 F.count(F.lit(1)).alias("lines")))
