"""Daily sales summary with month and week run rates on every day row.

The line fact is scanned and shuffled once, to the day x channel grain; every
coarser grain is built from that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.numbers import ratio, rnd, rnd_int, trunc_int
from tillbook.operators.series import month_number
from tillbook.session import stage

CHANNEL = ["store", "brand", "order_type", "platform"]
ATTRS = ["region", "manager", "open_date"]

# Monthly revenue bands (upper bound in won, label) and the label above them.
REVENUE_BANDS = [
    (10_000_000, "1천 이하"),
    (20_000_000, "1천 초과 ~ 2천 이하"),
    (30_000_000, "2천 초과 ~ 3천 이하"),
    (50_000_000, "3천초과 ~ 5천 이하"),
]
REVENUE_TOP_BAND = "5천 초과"


def revenue_band(c: Column) -> Column:
    """Label of the revenue band a monthly amount falls in."""
    out = F.lit(REVENUE_TOP_BAND)
    for limit, label in reversed(REVENUE_BANDS):
        out = F.when(c <= limit, label).otherwise(out)
    return out


def month_of(as_of) -> Column:
    return F.date_format(F.lit(as_of).cast("date"), "yyyy-MM")


def week_start(c) -> Column:
    return F.date_trunc("week", c).cast("date")


def active_days(keys) -> Column:
    """Days with sales: rows at channel grain (one per day), a distinct count at coarser ones."""
    return F.count(F.lit(1)) if list(keys) == CHANNEL else F.countDistinct("sale_date")


def daily_channel(lines: DataFrame) -> DataFrame:
    """Sales and orders per day, store, brand, order type and platform."""
    keys = ["sale_date", "ym", *CHANNEL]
    # Attributes ride along as keys so that the large aggregate stays hash based.
    pre = lines.groupBy(*keys, *ATTRS).agg(
        F.sum("total_price").alias("total_price"), F.sum("order_cnt").alias("order_cnt")
    )
    return pre.groupBy(*keys).agg(
        *[F.min(a).alias(a) for a in ATTRS],
        F.sum("total_price").alias("total_price"),
        F.sum("order_cnt").alias("order_cnt"),
    )


def monthly_channel(daily: DataFrame, keys=CHANNEL) -> DataFrame:
    """Month totals, active days and per-day averages per channel."""
    return (
        daily.groupBy("ym", *keys)
        .agg(
            F.sum("total_price").alias("month_sales"),
            F.sum("order_cnt").alias("month_order_cnt"),
            active_days(keys).alias("actual_days"),
            F.max("sale_date").alias("max_sale_date"),
        )
        .withColumn("avg_daily_sales", rnd(ratio("month_sales", "actual_days"), 2))
        .withColumn("avg_daily_order_cnt", rnd(ratio("month_order_cnt", "actual_days"), 2))
    )


def expected_month(monthly: DataFrame, as_of) -> DataFrame:
    """Past months keep the actual, the running month is average x days in month."""
    days = F.dayofmonth(F.last_day("max_sale_date"))
    this = month_of(as_of)

    def expect(actual, avg):
        return F.when(F.col("ym") < this, F.col(actual)).when(F.col("ym") == this, rnd_int(F.col(avg) * days)).otherwise(0)

    return monthly.withColumn("expected_month_sales", expect("month_sales", "avg_daily_sales")).withColumn(
        "expected_month_order_cnt", expect("month_order_cnt", "avg_daily_order_cnt")
    )


def prev_month_lag(expected: DataFrame, keys=CHANNEL) -> DataFrame:
    """Previous row's expected sales and order count per channel."""
    w = Window.partitionBy(*keys).orderBy("ym")
    return expected.withColumn(
        "prev_expected_month_sales", F.coalesce(F.lag("expected_month_sales").over(w), F.lit(0))
    ).withColumn("prev_month_order_cnt", F.coalesce(F.lag("month_order_cnt").over(w), F.lit(0)))


def avg_prev_3(expected: DataFrame, keys=CHANNEL) -> DataFrame:
    """Mean of the three previous rows, the current one excluded."""
    w = Window.partitionBy(*keys).orderBy("ym").rowsBetween(-3, -1)
    return expected.withColumn("avg_3m_expected_sales", rnd_int(F.avg("expected_month_sales").over(w))).withColumn(
        "avg_3m_order_cnt", rnd_int(F.avg("expected_month_order_cnt").over(w))
    )


def weekly_channel(daily: DataFrame, as_of, keys=CHANNEL) -> DataFrame:
    """Monday weeks per channel with run rate, previous week and 3-week mean."""
    this = week_start(F.lit(as_of).cast("date"))
    g = (
        daily.withColumn("week_start", week_start("sale_date"))
        .groupBy("week_start", *keys)
        .agg(
            F.sum("total_price").alias("week_sales"),
            F.sum("order_cnt").alias("week_order_cnt"),
            active_days(keys).alias("days_cnt"),
        )
        .withColumn("avg_dw", rnd(ratio("week_sales", "days_cnt"), 2))
        .withColumn("avg_dw_o", rnd(ratio("week_order_cnt", "days_cnt"), 2))
    )

    def expect(actual, avg):
        return (
            F.when(F.col("week_start") < this, F.col(actual))
            .when(F.col("week_start") == this, rnd_int(F.col(avg) * 7))
            .otherwise(0)
        )

    w = Window.partitionBy(*keys).orderBy("week_start")
    last3 = w.rowsBetween(-3, -1)
    return (
        g.withColumn("expected_week_sales", expect("week_sales", "avg_dw"))
        .withColumn("expected_week_order_cnt", expect("week_order_cnt", "avg_dw_o"))
        .withColumn("prev_expected_week_sales", F.coalesce(F.lag("expected_week_sales").over(w), F.lit(0)))
        .withColumn("prev_week_order_cnt", F.coalesce(F.lag("week_order_cnt").over(w), F.lit(0)))
        .withColumn("avg_3w_expected_sales", trunc_int(F.avg("expected_week_sales").over(last3)))
        .withColumn("avg_3w_order_cnt", trunc_int(F.avg("expected_week_order_cnt").over(last3)))
    )


def store_expected(daily: DataFrame, as_of, keys=("store", "brand")) -> DataFrame:
    """Store-level run rate; the previous month is the calendar one, so a missing month counts as 0.

    "The row exactly one month earlier" is a RANGE frame on the month number, not a self join.
    """
    keys = list(keys)
    this = month_of(as_of)
    g = (
        daily.groupBy(*keys, "ym")
        .agg(
            F.sum("total_price").alias("tp"),
            F.sum("order_cnt").alias("oc"),
            F.countDistinct("sale_date").alias("actual_days"),
            F.max("sale_date").alias("ms"),
        )
        .withColumn("avg_day_sales", rnd_int(ratio("tp", "actual_days")))
        .withColumn("avg_day_orders", rnd(ratio("oc", "actual_days"), 2))
    )
    days = F.dayofmonth(F.last_day("ms"))

    def expect(actual, avg):
        return F.when(F.col("ym") < this, F.col(actual)).when(F.col("ym") == this, rnd_int(F.col(avg) * days)).otherwise(0)

    g = g.withColumn("expected_sales", expect("tp", "avg_day_sales")).withColumn(
        "expected_orders", expect("oc", "avg_day_orders")
    )
    w = Window.partitionBy(*keys).orderBy("ym")
    last3 = w.rowsBetween(-3, -1)
    before = Window.partitionBy(*keys).orderBy(month_number(F.to_date(F.concat("ym", F.lit("-01"))))).rangeBetween(-1, -1)
    return (
        g.withColumn("prev_expected_sales", F.coalesce(F.max("expected_sales").over(before), F.lit(0)))
        .withColumn("prev_orders", F.coalesce(F.max("oc").over(before), F.lit(0)))
        .withColumn("avg3_sales", trunc_int(F.avg("expected_sales").over(last3)))
        .withColumn("avg3_orders", trunc_int(F.avg("expected_orders").over(last3)))
        .withColumn("prev_day_sales", F.coalesce(F.lag("avg_day_sales").over(w), F.lit(0)))
        .drop("ms")
    )


def store_month_rollup(daily: DataFrame, as_of) -> DataFrame:
    """Store x brand month run rate with the store's current revenue band."""
    exp = store_expected(daily, as_of)
    now = F.when(F.col("ym") == month_of(as_of), F.col("expected_sales"))
    total = F.sum(now).over(Window.partitionBy("store"))
    exp = exp.withColumn("_band", F.when(total.isNotNull(), revenue_band(total)))
    return exp.select(
        "ym", "store", "brand",
        F.col("expected_sales").alias("store_expected_month_sales"),
        F.col("expected_orders").alias("store_expected_month_order_cnt"),
        F.col("prev_expected_sales").alias("store_prev_expected_month_sales"),
        F.col("prev_orders").alias("store_prev_expected_month_order_cnt"),
        F.coalesce("_band", revenue_band(F.col("expected_sales"))).alias("status"),
    )


def daily_summary(lines: DataFrame, as_of) -> DataFrame:
    """Day rows with month, week and store figures joined back."""
    # Four branches read the day grain, so the line scan is staged once at that grain.
    daily = stage(daily_channel(lines))
    monthly = avg_prev_3(prev_month_lag(expected_month(monthly_channel(daily), as_of))).select(
        "ym", *CHANNEL,
        F.col("expected_month_sales").alias("_ems"), F.col("expected_month_order_cnt").alias("_emo"),
        "prev_expected_month_sales", "avg_3m_expected_sales", "prev_month_order_cnt", "avg_3m_order_cnt",
    )
    store_week = Window.partitionBy("week_start", "store", "brand")
    weekly = weekly_channel(daily, as_of).select(
        "week_start", *CHANNEL, "expected_week_sales", "expected_week_order_cnt",
        "prev_expected_week_sales", "avg_3w_expected_sales", "prev_week_order_cnt", "avg_3w_order_cnt",
        F.sum("expected_week_sales").over(store_week).alias("store_expected_week_sales"),
        F.sum("expected_week_order_cnt").over(store_week).alias("store_expected_week_order_cnt"),
    )
    past = F.col("ym") < month_of(as_of)
    return (
        daily.withColumn("week_start", week_start("sale_date"))
        .join(monthly, ["ym", *CHANNEL], "left")
        .join(store_month_rollup(daily, as_of), ["ym", "store", "brand"], "left")
        .join(weekly, ["week_start", *CHANNEL], "left")
        .withColumn("expected_month_sales", F.when(past, F.col("total_price")).otherwise(F.col("_ems")))
        .withColumn("expected_month_order_cnt", F.when(past, F.col("order_cnt")).otherwise(F.col("_emo")))
        .drop("_ems", "_emo")
    )
