"""Sorts, limits and set operations on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.core import col, top_k


def stable_sort(df: DataFrame, keys: Sequence) -> DataFrame:
    return df.orderBy(*[col(k) for k in keys])


def nlargest(df: DataFrame, group: Sequence[str], value: str, k: int, tie: Sequence = ()) -> DataFrame:
    return top_k(df, group, [F.col(value).desc(), *tie], k, rank="rank")


def nsmallest(df: DataFrame, group: Sequence[str], value: str, k: int, tie: Sequence = ()) -> DataFrame:
    return top_k(df, group, [F.col(value).asc(), *tie], k, rank="rank")


def limit_orders(lines: DataFrame, order: str, by: Sequence, n: int) -> DataFrame:
    """All lines of the first ``n`` distinct orders."""
    first = lines.select(order, *by).distinct().orderBy(*by, order).limit(n).select(order)
    return lines.join(first, order, "left_semi")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def key_intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def key_difference(expected: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(existing.select(*keys).distinct(), list(keys), "left_anti")
