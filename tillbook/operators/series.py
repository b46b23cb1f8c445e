"""Window columns over daily series (one row per key and day).

The input is already aggregated to days, so a window partition is bounded by
the calendar. Row-based frames count rows (missing days are skipped); the
calendar variants use RANGE frames on a day, week or month number, which gives
"the value exactly n days earlier" without a self join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.numbers import pct, ratio, rnd, rnd_int, trunc_int
from tillbook.operators.core import col, keep_one, top_k

EPOCH = "1970-01-05"  # a Monday


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def day_number(day) -> Column:
    return F.datediff(col(day), F.lit(EPOCH).cast("date"))


def week_number(day) -> Column:
    return F.floor(day_number(day) / 7).cast("int")


def month_number(day) -> Column:
    return F.year(col(day)) * 12 + F.month(col(day))


def rolling(fn, value, keys, day, first: int, last: int = 0, min_rows: int = 1) -> Column:
    """``fn`` over rows first..last relative to the current one, null below ``min_rows`` values."""
    w = Window.partitionBy(*_keys(keys)).orderBy(day).rowsBetween(first, last)
    return F.when(F.count(col(value)).over(w) >= min_rows, fn(col(value)).over(w))


def shifted(value, keys, day, days: int) -> Column:
    """Value of the row exactly ``days`` calendar days earlier."""
    return F.sum(col(value)).over(Window.partitionBy(*_keys(keys)).orderBy(day_number(day)).rangeBetween(-days, -days))


def prev_week_total(value, keys, day) -> Column:
    return F.sum(col(value)).over(Window.partitionBy(*_keys(keys)).orderBy(week_number(day)).rangeBetween(-1, -1))


def prev_month_total(value, keys, day) -> Column:
    return F.sum(col(value)).over(Window.partitionBy(*_keys(keys)).orderBy(month_number(day)).rangeBetween(-1, -1))


def prev_month_same_day(value, keys, day) -> Column:
    """Value on the same day of month one month earlier (null if that day has no row)."""
    position = month_number(day) * 100 + F.dayofmonth(col(day))
    return F.max(col(value)).over(Window.partitionBy(*_keys(keys)).orderBy(position).rangeBetween(-100, -100))


def _month_so_far(keys, day):
    return Window.partitionBy(*_keys(keys), F.trunc(col(day), "MM")).orderBy(day).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def mtd_sum(value, keys, day) -> Column:
    return F.sum(col(value)).over(_month_so_far(keys, day))


def mtd_mean(value, keys, day) -> Column:
    return F.avg(col(value)).over(_month_so_far(keys, day))


def wtd_sum(value, keys, day) -> Column:
    w = Window.partitionBy(*_keys(keys), week_number(day)).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(col(value)).over(w)


def rolling_sums(df: DataFrame, keys, day="sale_date", value="total_amount") -> DataFrame:
    """7-row sum and the 7 rows before, 30-row sum and the 30 before."""
    return df.withColumns(
        {
            "sum_7d_recent": trunc_int(rolling(F.sum, value, keys, day, -6)),
            "sum_7d_prev": trunc_int(rolling(F.sum, value, keys, day, -13, -7)),
            "sum_30d_recent": trunc_int(rolling(F.sum, value, keys, day, -29)),
            "sum_30d_prev": trunc_int(rolling(F.sum, value, keys, day, -59, -30)),
        }
    )


def moving_average(df: DataFrame, keys, day="sale_date", value="total_amount", digits=2) -> DataFrame:
    """14-row mean (7 values needed) and 28-row mean (14 needed)."""
    return df.withColumns(
        {
            "ma_14": rnd(rolling(F.avg, value, keys, day, -13, 0, 7), digits),
            "ma_28": rnd(rolling(F.avg, value, keys, day, -27, 0, 14), digits),
        }
    )


def mtd_cumsum(df: DataFrame, keys, day="sale_date", value="total_amount") -> DataFrame:
    """Month-to-date sum and its value on the same day of the previous month."""
    out = df.withColumn("amt_curr_mtd", trunc_int(mtd_sum(value, keys, day)))
    return out.withColumn("amt_prev_mtd", trunc_int(prev_month_same_day("amt_curr_mtd", keys, day)))


def mtd_expanding_mean(df: DataFrame, keys, day="sale_date", value="total_amount", digits=2) -> DataFrame:
    return df.withColumn("mtd_mean", rnd(mtd_mean(value, keys, day), digits))


def same_weekday_lags(df: DataFrame, keys, day="sale_date", value="total_amount", weeks=4) -> DataFrame:
    """The previous 1..n rows that fall on the same weekday."""
    w = Window.partitionBy(*_keys(keys), F.weekday(col(day))).orderBy(day)
    return df.withColumns({f"prev_{i}w_same_day": trunc_int(F.lag(col(value), i).over(w)) for i in range(1, weeks + 1)})


def status_lag(df: DataFrame, keys, day="sale_date", status="status", rows=7, default="정상", out="pre_status"):
    w = Window.partitionBy(*_keys(keys)).orderBy(day)
    return df.withColumn(out, F.coalesce(F.lag(col(status), rows).over(w), F.lit(default)))


def calendar_comparisons(df: DataFrame, keys, day="sale_date", value="total_amount", orders="total_order_count"):
    """Previous day, same weekday last week, previous week / month totals, with changes in percent."""
    out = df.withColumns(
        {
            "prev_day": trunc_int(shifted(value, keys, day, 1)),
            "prev_week_day": trunc_int(shifted(value, keys, day, 7)),
            "prev_week_orders": trunc_int(shifted(orders, keys, day, 7)),
            "prev_week_total": trunc_int(prev_week_total(value, keys, day)),
            "prev_month_total": trunc_int(prev_month_total(value, keys, day)),
        }
    )
    return out.withColumns(
        {
            "vs_prev_day_pct": pct(value, "prev_day"),
            "vs_prev_week_day_pct": pct(value, "prev_week_day"),
            "vs_prev_month_pct": pct(value, "prev_month_total"),
        }
    )


def wtd_mtd_vs_prev_total(df: DataFrame, keys, day="sale_date", value="total_amount") -> DataFrame:
    """Running week / month against the whole previous week / month."""
    out = df.withColumns(
        {
            "wtd": trunc_int(wtd_sum(value, keys, day)),
            "mtd": trunc_int(mtd_sum(value, keys, day)),
            "prev_week_total": trunc_int(prev_week_total(value, keys, day)),
            "prev_month_total": trunc_int(prev_month_total(value, keys, day)),
        }
    )
    return out.withColumns(
        {
            "week_change": F.col("wtd") - F.col("prev_week_total"),
            "week_change_pct": pct("wtd", "prev_week_total"),
            "month_change": F.col("mtd") - F.col("prev_month_total"),
            "month_change_pct": pct("mtd", "prev_month_total"),
        }
    )


def cumulative_tracking(df: DataFrame, keys, day: str, sums, ratios, per_day) -> DataFrame:
    """Running totals inside ``keys``, running ratios (num, den) and averages per elapsed row."""
    w = Window.partitionBy(*_keys(keys)).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("elapsed", F.count(F.lit(1)).over(w)).withColumns({f"cum_{c}": F.sum(c).over(w) for c in sums})
    zero = F.lit(0.0)
    out = out.withColumns(
        {
            name: F.coalesce(rnd(F.when(F.col(f"cum_{d}") > 0, ratio(f"cum_{n}", f"cum_{d}")), 2), zero)
            for name, (n, d) in ratios.items()
        }
    )
    return out.withColumns({f"{c}_per_day": rnd(ratio(f"cum_{c}", "elapsed"), 1) for c in per_day})


def mtd_avg_trend(daily_totals: DataFrame, target, days: int = 30, day="sale_date", value="sales") -> DataFrame:
    """Last ``days`` rows up to ``target``: average sales per day of month and growth against the row before."""
    upto = daily_totals.where(F.col(day) <= F.lit(target).cast("date"))
    run = upto.withColumn("total_sales", mtd_sum(value, [], day)).withColumn(
        "avg_sales", rnd_int(ratio("total_sales", F.dayofmonth(day)))
    )
    last = run.orderBy(F.col(day).desc()).limit(days)
    growth = ratio("avg_sales", F.lag("avg_sales").over(Window.orderBy(day))) - 1
    return last.select(
        day, "total_sales", F.dayofmonth(day).alias("day_count"), "avg_sales", rnd(growth * 100, 4).alias("growth_pct")
    )


def price_ma(quotes: DataFrame, site="site", day="base_date", price="price", spans=(20, 60, 120)) -> DataFrame:
    """Latest quote per site with moving averages over full spans only."""
    daily = keep_one(quotes, [site, day], [F.col("collected_at").desc()])
    last = top_k(daily, [site], [F.col(day).desc()], max(spans), rank="_back")
    means = [
        F.when(F.count(F.when(F.col("_back") <= n, F.col(price))) >= n, F.avg(F.when(F.col("_back") <= n, F.col(price))))
        for n in spans
    ]
    return last.groupBy(site).agg(
        F.max(day).alias(day),
        F.max(F.when(F.col("_back") == 1, F.col(price))).alias("price"),
        *[rnd(m, 2).alias(f"ma{n}") for m, n in zip(means, spans)],
    )
