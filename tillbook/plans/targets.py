"""Targets: achievement, weekly split, month forecast, report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.numbers import ratio, rnd, rnd_int
from tillbook.functions.rules import achievement_grade, sales_diagnosis
from tillbook.plans.marts import WEEKDAY

NO_TARGET = "목표없음"


def target_achievement(daily: DataFrame, targets: DataFrame, done_days: DataFrame | None = None) -> DataFrame:
    """Actual against weekday / weekend target with grade, unit price gap, packaging share and diagnosis.

    Only (month, store, brand) keys with targets count; days already analysed are left out.
    """
    if done_days is not None:
        daily = daily.join(done_days.select("sale_date").distinct(), "sale_date", "left_anti")
    j = daily.join(targets, ["ym", "store", "brand"])
    j = j.withColumn("target", F.when(F.col("day_kind") == WEEKDAY, F.col("weekday_target")).otherwise(F.col("weekend_target")))
    rate = F.when(F.col("target") > 0, rnd(ratio("total_sales", "target") * 100, 1))
    j = j.withColumns(
        {
            "diff": F.col("total_sales") - F.col("target"), "rate": rate,
            "price_diff": F.col("table_price") - F.col("target_price"),
            "pack_share": F.when(F.col("total_sales") > 0, rnd(ratio("hall_pack_sales", "total_sales") * 100, 1)).otherwise(0.0),
        }
    )
    j = j.withColumn("grade", F.when(F.col("rate").isNull(), NO_TARGET).otherwise(achievement_grade("rate")))
    why = sales_diagnosis("grade", "target_price", "table_price", "tables", "pack_share")
    return j.withColumn("diagnosis", F.when(F.col("grade") == NO_TARGET, NO_TARGET).otherwise(why))


def missing_targets(daily: DataFrame, targets: DataFrame) -> DataFrame:
    """Keys with sales but no complete target."""
    have = targets.where(F.col("weekday_target").isNotNull() & F.col("weekend_target").isNotNull())
    return daily.select("ym", "store", "brand").distinct().join(have, ["ym", "store", "brand"], "left_anti")


def backfill_columns(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill nulls of stored rows from a fresh computation of the same rows."""
    new = fresh.select(*keys, *[F.col(c).alias(f"_f_{c}") for c in columns])
    out = existing.join(new, list(keys), "left")
    return out.withColumns({c: F.coalesce(c, f"_f_{c}") for c in columns}).select(*existing.columns)


def weekly_target_split(months: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Month target / days in month x days of the Monday week inside the month."""
    first = F.to_date(F.concat(F.col("ym"), F.lit("-01")))
    days = months.withColumn("_day", F.explode(F.sequence(first, F.last_day(first))))
    weeks = days.groupBy("ym", *keys, F.date_trunc("week", "_day").cast("date").alias("week_start"), *metrics).agg(
        F.count(F.lit(1)).alias("days")
    )
    dim = F.dayofmonth(F.last_day(first))
    return weeks.select("ym", *keys, "week_start", "days", *[rnd_int(F.col(m) / dim * F.col("days")).alias(f"{m}_target") for m in metrics])


def weekly_tracking(weekly: DataFrame, targets: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Weekly actuals beside their targets (0 when a month has none)."""
    j = weekly.join(targets, ["ym", *keys, "week_start"], "left").fillna(0, [f"{m}_target" for m in metrics])
    return j.withColumns({f"{m}_rate": rnd(ratio(m, f"{m}_target") * 100, 1) for m in metrics}).drop("days")


def month_forecast_fill(daily: DataFrame, stores: DataFrame, ym: str, metrics: dict[str, int], least: int = 3) -> DataFrame:
    """Full month grid: actual days, the rest by regression on the day of month, or the daily target below ``least`` days.

    ``metrics`` maps a metric to its daily target.
    """
    first = F.to_date(F.lit(f"{ym}-01"))
    month = daily.where(F.date_format("sale_date", "yyyy-MM") == ym)
    x = F.dayofmonth("sale_date")
    fit = month.groupBy("store").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.regr_slope(F.col(m).cast("double"), x.cast("double")).alias(f"_s_{m}") for m in metrics],
        *[F.regr_intercept(F.col(m).cast("double"), x.cast("double")).alias(f"_i_{m}") for m in metrics],
    )
    grid = stores.select("store", F.explode(F.sequence(first, F.last_day(first))).alias("sale_date"))
    j = grid.join(month.select("store", "sale_date", *metrics, F.lit(1).alias("_a")), ["store", "sale_date"], "left").join(fit, "store", "left")
    guess = lambda m, t: F.when(F.coalesce("_n", F.lit(0)) < least, F.lit(t)).otherwise(
        # Decimal rounding: the fitted value carries binary noise that must not decide a tie.
        F.greatest(rnd(F.col(f"_s_{m}") * x + F.col(f"_i_{m}"), 0).cast("bigint"), F.lit(0))
    )
    return j.select(
        "store", "sale_date", F.when(F.col("_a") == 1, "실제값").otherwise("예측값").alias("kind"),
        *[F.coalesce(F.col(m), guess(m, t)).cast("bigint").alias(m) for m, t in metrics.items()],
    )


def report_matrix(weekly: DataFrame, month_targets: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(month, week, metric, month target, month to date, rate, week target, week, rate) rows of the report matrix."""
    w = Window.partitionBy("ym").orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    base = weekly.withColumns({f"{m}_mtd": F.sum(m).over(w) for m in metrics})
    base = base.join(month_targets.select("ym", *[F.col(m).alias(f"{m}_month") for m in metrics]), "ym", "left")
    cell = lambda m: F.struct(
        F.lit(m).alias("metric"), F.col(f"{m}_month").cast("bigint").alias("month_target"), F.col(f"{m}_mtd").cast("bigint").alias("mtd"),
        F.col(f"{m}_target").cast("bigint").alias("week_target"), F.col(m).cast("bigint").alias("wtd"),
    )
    long = base.select("ym", "week_start", F.explode(F.array(*[cell(m) for m in metrics])).alias("c")).select("ym", "week_start", "c.*")
    return long.withColumn("month_rate", rnd(ratio("mtd", "month_target") * 100, 1)).withColumn(
        "week_rate", rnd(ratio("wtd", "week_target") * 100, 1)
    )
