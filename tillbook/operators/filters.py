"""Row filters and the alerts built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.numbers import ratio, rnd
from tillbook.operators.core import col


def store_scoped_blacklist(lines: DataFrame, blacklist: DataFrame, key: Column, removed: bool = False) -> DataFrame:
    """Lines whose item key is black-listed for all stores (empty store list) or for their store.

    Two equi anti joins instead of one "store is null or equal" condition, which
    would run as a nested loop. ``removed`` returns the lines taken out instead.
    """
    listed = blacklist.select(
        F.col("item_key").alias("_bk"),
        F.explode(
            F.when(F.trim(F.coalesce("stores", F.lit(""))) == "", F.array(F.lit("")))
            .otherwise(F.filter(F.transform(F.split("stores", ","), lambda x: F.trim(x)), lambda x: x != ""))
        ).alias("_bs"),
    ).distinct()
    everywhere = listed.where(F.col("_bs") == "").select("_bk")
    local = listed.where(F.col("_bs") != "")
    rows = lines.withColumn("_key", key)
    if not removed:
        kept = rows.join(everywhere, rows["_key"] == everywhere["_bk"], "left_anti")
        return kept.join(local, (kept["_key"] == local["_bk"]) & (kept["store"] == local["_bs"]), "left_anti").drop("_key")
    hits = everywhere.select(F.col("_bk").alias("_gk"), F.lit(1).alias("_g"))
    flagged = rows.join(hits, rows["_key"] == hits["_gk"], "left").join(
        local.withColumn("_l", F.lit(1)), (rows["_key"] == local["_bk"]) & (rows["store"] == local["_bs"]), "left"
    )
    return flagged.where(F.coalesce("_g", "_l").isNotNull()).select(*lines.columns)


def exclusion_report(removed: DataFrame, keys: Sequence[str] = ("ym", "store", "item_name")) -> DataFrame:
    """Count, quantity, amount and the days of the removed lines per month, store and item."""
    per_day = removed.groupBy(*keys, "sale_date").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("qty").alias("_q"), F.sum("total_price").alias("_a")
    )
    return per_day.groupBy(*keys).agg(
        F.sum("_n").alias("lines"), F.sum("_q").alias("qty"), F.sum("_a").alias("amount"),
        F.array_join(F.array_sort(F.collect_set(F.date_format("sale_date", "yyyy-MM-dd"))), ",").alias("days"),
    )


def exclude_overlapping_stores(low: DataFrame, high: DataFrame, keys: Sequence[str] = ("store",)) -> DataFrame:
    """Rows of the weaker source whose store the stronger one does not cover."""
    return low.join(high.select(*keys).distinct(), list(keys), "left_anti")


def invalid_date_filter(df: DataFrame, text: str, out: str, first="2020-01-01", last="2100-12-31") -> DataFrame:
    """Text to date; rows that do not parse or lie outside the range are dropped."""
    d = F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd")])
    return df.withColumn(out, d.cast("date")).where(
        F.col(out).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def complete_weeks_only(df: DataFrame, day: str, as_of) -> DataFrame:
    return df.where(F.col(day) < F.date_trunc("week", F.lit(as_of).cast("date")).cast("date"))


def missing_settlement_check(df: DataFrame, keys: Sequence[str], paid: str, settled: str) -> DataFrame:
    """Paid lines without a settlement: number and sum per key."""
    bad = (F.col(paid) > 0) & (F.coalesce(F.col(settled), F.lit(0)) == 0)
    return df.where(bad).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(paid).alias("paid"))


def voc_drop_alert(summary: DataFrame, managers: DataFrame, as_of, falling: bool = True) -> DataFrame:
    """Stores whose 30-row negative count fell (or rose) on the day before the report day."""
    move = F.col("pct_change_30d") < 0 if falling else F.col("pct_change_30d") > 0
    day = F.date_sub(F.lit(as_of).cast("date"), 1)
    return summary.where((F.col("d") == day) & move).drop("manager").join(managers, "store", "left")


def price_anomaly(df: DataFrame, keys: Sequence[str], day: str, price: str, limit: float = 0.2) -> DataFrame:
    """Day-over-day move of at least ``limit``, and prices that are not positive."""
    w = Window.partitionBy(*keys).orderBy(day)
    out = df.withColumn("prev_price", F.lag(price).over(w))
    move = F.col("_move")
    reason = F.when(F.col(price) <= 0, "invalid").when(F.abs(move) >= limit, F.when(move > 0, "jump").otherwise("drop"))
    return (
        out.withColumn("_move", ratio(F.col(price) - F.col("prev_price"), "prev_price"))
        .withColumn("change_pct", rnd(move * 100, 2))
        .withColumn("reason", reason)
        .drop("_move")
    )


def due_pending_split(actions: DataFrame, as_of, wait: int = 7, kind: str = "조치") -> tuple[DataFrame, DataFrame]:
    """(due rows of the given class, rows still waiting); a missing date keeps waiting."""
    ready = F.coalesce(F.date_add("action_date", wait) <= F.lit(as_of).cast("date"), F.lit(False))
    return actions.where(ready & (F.trim("kind") == kind)), actions.where(~ready)


def final_columns(df: DataFrame, wanted: Sequence[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Wanted columns in order, missing ones ignored, then renamed."""
    out = df.select([c for c in wanted if c in df.columns])
    return out.withColumnsRenamed({k: v for k, v in (renames or {}).items() if k in out.columns})
