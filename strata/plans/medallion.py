"""Medallion compositions (M1, M3, M5 building blocks) as lazy plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strata.operators import gold, silver


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    members: DataFrame


def medallion(bronze: DataFrame, *, key: str = "id", group_by: str = "region",
              order_col: str = "_ord") -> Layers:
    """M1 as one lazy plan: required key -> keep first per key -> group count.

    The silver and gold plans share the bronze scan; when both are written,
    the caller writes silver first and derives gold from the written table.
    """
    s = silver.keep_first(silver.require_keys(bronze, key), key, order_col=order_col)
    return Layers(bronze=bronze, silver=s,
                  gold=gold.group_count(s, group_by),
                  members=gold.group_members(s, group_by, key, order_col))
