"""Risk scores over daily store, manager and advertising series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.numbers import pct, ratio, rnd, rnd_int, trunc_int
from tillbook.operators import series as s
from tillbook.operators.core import col

# Status labels from best to worst, and the score each one starts at.
NORMAL, WATCH, CAUTION, DANGER = "정상", "관심", "주의", "위험"
STATUS_LIMITS = ((5, DANGER), (3, CAUTION), (2, WATCH))
SERVICE_LIMITS = ((15, DANGER), (10, CAUTION), (5, WATCH))
# The scorecard's own grade names by total score.
SCORECARD_GRADES = ((5, "위험"), (3, "경고"), (1, "주의"))


def banded(score: Column, limits, default=NORMAL) -> Column:
    out = F.lit(default)
    for limit, label in sorted(limits):
        out = F.when(score >= limit, label).otherwise(out)
    return out


def sales_drop_score(now, base) -> Column:
    """0 when level or up, 1 for a drop under 10 %, 2 from 10 % on."""
    change = ratio(col(now) - col(base), base)
    return F.when(change.isNull() | (change >= 0), 0).when(change > F.lit(-0.1), 1).otherwise(2)


def ratio_move_score(now, base, bad: str) -> Column:
    """Score of a ratio that moves in its bad direction ('up' or 'down')."""
    change = ratio(col(now) - col(base), base)
    if bad == "down":
        change = -change
    return F.when(change > F.lit(0.1), 2).when(change > 0, 1).otherwise(0)


def store_risk_score(series: DataFrame, keys="store", status_keys=("store", "manager")) -> DataFrame:
    """Trend, week and month scores of a daily sales series with the status seven rows earlier."""
    out = s.mtd_cumsum(s.moving_average(series, keys), keys).withColumns(
        {
            "sum_7d_recent": trunc_int(s.rolling(F.sum, "total_amount", keys, "sale_date", -6)),
            "sum_7d_prev": trunc_int(s.rolling(F.sum, "total_amount", keys, "sale_date", -13, -7)),
        }
    )
    out = out.withColumns(
        {
            "score_trend": sales_drop_score("ma_14", "ma_28"),
            "score_7d_total": sales_drop_score("sum_7d_recent", "sum_7d_prev"),
            "score_4week_total": sales_drop_score("amt_curr_mtd", "amt_prev_mtd"),
        }
    )
    out = out.withColumn("score", F.col("score_trend") + F.col("score_7d_total") + F.col("score_4week_total"))
    out = out.withColumn("status", banded(F.col("score"), STATUS_LIMITS))
    return s.calendar_comparisons(s.status_lag(out, status_keys), keys).drop("prev_week_total")


def manager_risk_score(daily: DataFrame) -> DataFrame:
    """The same per manager, with same-weekday score and settlement comparisons."""
    k, day = "manager", "sale_date"
    out = s.same_weekday_lags(s.mtd_cumsum(s.moving_average(daily, k), k), k).withColumns(
        {
            "sum_7d_recent": trunc_int(s.rolling(F.sum, "total_amount", k, day, -6)),
            "sum_7d_prev": trunc_int(s.rolling(F.sum, "total_amount", k, day, -13, -7)),
        }
    )
    out = out.withColumns(
        {
            "score_trend": sales_drop_score("ma_14", "ma_28"),
            "score_total": sales_drop_score("total_amount", "prev_1w_same_day"),
            "score_7d_total": sales_drop_score("sum_7d_recent", "sum_7d_prev"),
            "score_4week_total": sales_drop_score("amt_curr_mtd", "amt_prev_mtd"),
        }
    )
    out = out.withColumn("score", F.col("score_trend") + F.col("score_7d_total") + F.col("score_4week_total"))
    out = s.status_lag(out.withColumn("status", banded(F.col("score"), STATUS_LIMITS)), k)
    out = s.wtd_mtd_vs_prev_total(out, k)
    settle = "settlement_amount"
    out = out.withColumns(
        {
            "prev_day": trunc_int(s.shifted("total_amount", k, day, 1)),
            "prev_day_settle": trunc_int(s.shifted(settle, k, day, 1)),
            "prev_week_day": trunc_int(s.shifted("total_amount", k, day, 7)),
            "prev_week_settle": trunc_int(s.prev_week_total(settle, k, day)),
            "prev_month_settle": trunc_int(s.prev_month_total(settle, k, day)),
        }
    )
    return out.withColumns(
        {
            "vs_prev_day": F.col("total_amount") - F.col("prev_day"),
            "vs_prev_day_pct": pct("total_amount", "prev_day"),
            "vs_prev_week_day": F.col("total_amount") - F.col("prev_week_day"),
            "vs_prev_week_day_pct": pct("total_amount", "prev_week_day"),
            "settle_vs_prev_day_pct": pct(settle, "prev_day_settle"),
            "settle_vs_prev_week_pct": pct(settle, "prev_week_settle"),
            "settle_vs_prev_month_pct": pct(settle, "prev_month_settle"),
        }
    )


def _ratio_scores(df: DataFrame, value: str, mtd: Column, bad: str, keys, day, digits: int, name: str) -> DataFrame:
    """Trend, 7-row and month scores of one measured value."""
    df = df.withColumns(
        {
            f"{name}_ma14": rnd(s.rolling(F.avg, value, keys, day, -13, 0, 7), digits),
            f"{name}_ma28": rnd(s.rolling(F.avg, value, keys, day, -27, 0, 14), digits),
            f"{name}_7d": rnd(s.rolling(F.avg, value, keys, day, -6), digits),
            f"{name}_7d_prev": rnd(s.rolling(F.avg, value, keys, day, -13, -7), digits),
            f"{name}_mtd": rnd(mtd, digits),
        }
    )
    df = df.withColumn(
        f"{name}_mtd_prev", F.coalesce(s.prev_month_same_day(f"{name}_mtd", keys, day), F.lit(0.0))
    )
    return df.withColumns(
        {
            f"{name}_trend_score": ratio_move_score(f"{name}_ma14", f"{name}_ma28", bad),
            f"{name}_week_score": ratio_move_score(f"{name}_7d", f"{name}_7d_prev", bad),
            f"{name}_month_score": ratio_move_score(f"{name}_mtd", f"{name}_mtd_prev", bad),
        }
    ).withColumn(
        f"{name}_score",
        F.col(f"{name}_trend_score") + F.col(f"{name}_week_score") + F.col(f"{name}_month_score"),
    )


def fee_ratio_score(series: DataFrame, keys="store", day="sale_date") -> DataFrame:
    """Fee share of sales; the month value is a ratio of running sums; rising is bad."""
    total, fee = F.col("total_amount"), F.col("total_amount") - F.col("settlement_amount")
    df = series.withColumn("fee_ratio", rnd(F.when(total > 0, ratio(fee, total)), 4))
    run_total = s.mtd_sum(total, keys, day)
    mtd = F.when(run_total > 0, ratio(s.mtd_sum(F.coalesce(fee, F.lit(0)), keys, day), run_total))
    df = _ratio_scores(df, "fee_ratio", mtd, "up", keys, day, 4, "fee")
    df = df.withColumn("fee_status", banded(F.col("fee_score"), STATUS_LIMITS))
    return s.status_lag(df, keys, day, "fee_status", out="pre_fee_status")


def ad_effect_score(ads: DataFrame, clicks: str, shown: str, name: str, keys="store", day="d") -> DataFrame:
    """Clicks per impression of one ad platform; falling is bad."""
    df = ads.withColumn(name, rnd(ratio(clicks, shown), 4))
    run_shown = s.mtd_sum(shown, keys, day)
    mtd = F.when(run_shown > 0, ratio(s.mtd_sum(clicks, keys, day), run_shown))
    df = _ratio_scores(df, name, mtd, "down", keys, day, 4, name)
    df = df.withColumn(f"{name}_status", banded(F.col(f"{name}_score"), STATUS_LIMITS))
    return s.status_lag(df, keys, day, f"{name}_status", out=f"pre_{name}_status")


# Service measures: column, direction that is bad, digits kept.
SERVICE_METRICS = (("cook_time", "up", 2), ("accept_time", "up", 2), ("reorder_rate", "down", 4), ("stars", "down", 2))


def service_score(measures: DataFrame, metrics=SERVICE_METRICS, keys="store", day="d") -> DataFrame:
    """Sum of the scores of all service measures, in four bands."""
    df = measures
    for name, bad, digits in metrics:
        df = _ratio_scores(df, name, s.mtd_mean(name, keys, day), bad, keys, day, digits, name)
    total = sum((F.col(f"{n}_score") for n, _, _ in metrics), F.lit(0))
    df = df.withColumn("service_score_total", total)
    df = df.withColumn("service_status", banded(F.col("service_score_total"), SERVICE_LIMITS))
    return s.status_lag(df, keys, day, "service_status", out="pre_service_status")


def period_comparison(series: DataFrame, keys="store", day="sale_date", parts=()) -> DataFrame:
    """Fee rate now, previous day and same weekday last week, overall and per platform suffix."""
    df = series
    for p in ["", *[f"_{x}" for x in parts]]:
        total, settle = f"total_amount{p}", f"settlement_amount{p}"
        df = df.withColumns(
            {
                f"fee_rate{p}": rnd(ratio(F.col(total) - F.col(settle), total) * 100, 2),
                f"prev_day{p}": s.shifted(total, keys, day, 1),
                f"prev_week_day{p}": s.shifted(total, keys, day, 7),
                f"_psd{p}": s.shifted(settle, keys, day, 1),
                f"_psw{p}": s.shifted(settle, keys, day, 7),
            }
        )
        df = df.withColumns(
            {
                f"prev_day_fee_rate{p}": rnd(ratio(F.col(f"prev_day{p}") - F.col(f"_psd{p}"), f"prev_day{p}") * 100, 2),
                f"prev_week_fee_rate{p}": rnd(
                    ratio(F.col(f"prev_week_day{p}") - F.col(f"_psw{p}"), f"prev_week_day{p}") * 100, 2
                ),
                f"vs_prev_day_pct{p}": pct(total, f"prev_day{p}"),
                f"vs_prev_week_pct{p}": pct(total, f"prev_week_day{p}"),
            }
        ).drop(f"_psd{p}", f"_psw{p}")
        df = df.withColumns(
            {
                f"fee_vs_prev_day{p}": rnd(F.col(f"fee_rate{p}") - F.col(f"prev_day_fee_rate{p}"), 2),
                f"fee_vs_prev_week{p}": rnd(F.col(f"fee_rate{p}") - F.col(f"prev_week_fee_rate{p}"), 2),
            }
        )
    return df


def _fall_score(p: Column, mild: int, steep: int) -> Column:
    return F.when(p <= -steep, 2).when(p <= -mild, 1).otherwise(0)


def sales_scorecard(daily: DataFrame, target, keys=("store",), day="sale_date", value="sales") -> DataFrame:
    """Short, mid, long and year view of each key for one report day.

    One conditional aggregate over the days that any of the four views reads.
    """
    d, t = F.col(day), F.lit(target).cast("date")
    month0 = F.trunc(t, "MM").cast("date")
    prev0 = F.add_months(month0, -1)
    year0 = F.add_months(month0, -12)
    elapsed = F.dayofmonth(t) - 1
    v = F.col(value)

    def total(lo, hi):
        return F.coalesce(F.sum(F.when(d.between(lo, hi), v)), F.lit(0))

    same_weekday = [F.date_sub(t, 7 * w) for w in range(1, 5)]
    g = daily.where(d.between(year0, t)).groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(d == t, v)), F.lit(0)).alias("today_sales"),
        rnd_int(F.avg(F.when(d.isin(same_weekday), v))).alias("short_base_avg"),
        total(F.date_sub(t, 13), t).alias("mid_recent14"),
        total(F.date_sub(t, 27), F.date_sub(t, 14)).alias("mid_prev14"),
        total(month0, t).alias("mtd_curr"),
        total(prev0, F.date_add(prev0, elapsed)).alias("long_prev_mtd"),
        total(prev0, F.last_day(prev0)).alias("prev_month_total"),
        total(year0, F.date_add(year0, elapsed)).alias("yoy_prev_mtd"),
    )

    def change(now, base):
        return F.when(F.col(base) > 0, (ratio(now, base) - 1) * 100)

    g = g.withColumns(
        {
            "mtd_avg": rnd_int(ratio("mtd_curr", F.dayofmonth(t))),
            "prev_month_avg": rnd_int(ratio("prev_month_total", F.dayofmonth(F.last_day(prev0)))),
            "short_pct": change("today_sales", "short_base_avg"),
            "mid_pct": change("mid_recent14", "mid_prev14"),
            "long_pct": change("mtd_curr", "long_prev_mtd"),
            "yoy_pct": change("mtd_curr", "yoy_prev_mtd"),
        }
    )
    g = g.withColumns(
        {
            "mtd_avg_vs_prev_pct": rnd(change("mtd_avg", "prev_month_avg"), 4),
            "short_score": _fall_score(F.col("short_pct"), 5, 10),
            "mid_score": _fall_score(F.col("mid_pct"), 3, 7),
            "long_score": _fall_score(F.col("long_pct"), 3, 7),
            "yoy_score": _fall_score(F.col("yoy_pct"), 5, 10),
        }
    )
    total_score = sum((F.col(f"{x}_score") for x in ("short", "mid", "long", "yoy")), F.lit(0))
    g = g.withColumn("total_score", total_score).withColumn("grade", banded(F.col("total_score"), SCORECARD_GRADES))
    return g.withColumns({c: rnd(c, 4) for c in ("short_pct", "mid_pct", "long_pct", "yoy_pct")})


def latest_complete_date(df: DataFrame, day: str, share: float = 0.5, floor: int = 10) -> DataFrame:
    """One row: the latest day with at least half the median daily row count, else the latest day."""
    counts = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    # One entry per calendar day, so the collected list is bounded by the calendar.
    days = counts.agg(
        F.collect_list(F.struct(F.col(day).alias("d"), "n")).alias("days"),
        F.greatest(F.percentile("n", 0.5) * share, F.lit(float(floor))).alias("need"),
        F.max(day).alias("latest"),
    )
    complete = F.filter("days", lambda x: x["n"] >= F.col("need"))
    return days.select(
        F.coalesce(F.array_max(F.transform(complete, lambda x: x["d"])), F.col("latest")).alias("target_date")
    )


#: The five scored areas, as (status, status a week earlier).
STATUS_PAIRS = (
    ("status", "pre_status"), ("fee_status", "pre_fee_status"), ("ad_b_status", "pre_ad_b_status"),
    ("ad_a_status", "pre_ad_a_status"), ("service_status", "pre_service_status"),
)


def consecutive_risk(columns: Sequence[str], pairs=STATUS_PAIRS) -> Column:
    """True when any area is at its worst in both weeks; an area without an earlier status counts by the present one."""
    hit = F.lit(False)
    for now, before in pairs:
        if now in columns:
            worst = F.col(now) == DANGER
            hit = hit | F.coalesce(worst & (F.col(before) == DANGER) if before in columns else worst, F.lit(False))
    return hit


def max_score_per_group(df: DataFrame, group: str | Sequence[str], score: str) -> DataFrame:
    """Rows whose score equals the group's maximum; ties stay."""
    value = F.coalesce(F.col(score), F.lit(0))
    best = F.max(value).over(Window.partitionBy(group))
    return df.withColumn("_best", best).where(value >= F.col("_best")).drop("_best")


def risk_alerts(scored: DataFrame, day: str, group: str, score: str, days: int = 0) -> DataFrame:
    """Rows of the last complete day (and ``days`` before it) at their worst two weeks running, of each group and day the highest score."""
    target = latest_complete_date(scored.select(day), day)
    at = scored.join(target, scored[day] >= F.date_sub(target["target_date"], days)).drop("target_date")
    return max_score_per_group(at.where(consecutive_risk(scored.columns)), [group, day], score)
