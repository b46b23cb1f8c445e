"""Aggregate marts: daily actuals, channels, menu, reviews, tickets, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.numbers import pct, ratio, rnd, rnd_int, trunc_int
from tillbook.operators import series as s
from tillbook.operators.core import col, keep_one, top_k
from tillbook.session import stage

AGG_FUNCTIONS = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "nunique": F.countDistinct,
    "first": lambda c: F.first(c, ignorenulls=True), "std": F.stddev_samp,
}


def agg_generic(df: DataFrame, keys: Sequence[str], spec: dict) -> DataFrame:
    """Group by ``keys`` with ``{column: function or [functions]}``; results are named column_function."""
    missing = [c for c in [*keys, *spec] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    aggs = []
    for c, fns in spec.items():
        for fn in [fns] if isinstance(fns, str) else fns:
            aggs.append(AGG_FUNCTIONS[fn](c).alias(f"{c}_{fn}"))
    return df.groupBy(*keys).agg(*aggs)


def joined_set(c, sep=",") -> Column:
    """Sorted distinct values as one text."""
    return F.array_join(F.array_sort(F.collect_set(col(c))), sep)


def share_pct(part, whole, digits=1) -> Column:
    return F.coalesce(rnd(ratio(part, whole) * 100, digits), F.lit(0.0))


# Order types of the unified fact.
HALL_TABLE, HALL_PACK, HALL_COUNTER = "홀_테이블", "홀_포장", "홀_카운터"
WEEKDAY, WEEKEND = "평일", "주말"


def weekday_flag(day) -> Column:
    return F.when(F.weekday(col(day)) >= 5, WEEKEND).otherwise(WEEKDAY)


def store_daily_actuals(lines: DataFrame) -> DataFrame:
    """Hall, table, packaging, delivery and total sales with the table count, in one pass."""
    ot, price = F.col("order_type"), F.col("total_price")
    table, pack = ot == HALL_TABLE, ot.isin(HALL_PACK, HALL_COUNTER)
    part = lambda cond: F.coalesce(F.sum(F.when(cond, price)), F.lit(0))
    g = lines.groupBy("sale_date", "ym", "store", "brand").agg(
        F.sum(price).alias("total_sales"),
        part(table | pack).alias("hall_sales"),
        part(table).alias("hall_table_sales"),
        part(pack).alias("hall_pack_sales"),
        part(~ot.contains("홀")).alias("delivery_sales"),
        F.countDistinct(F.when(table, F.col("order_id"))).alias("tables"),
    )
    # The unit price divides all sales, not the table sales, by the table count.
    return g.withColumn("table_price", rnd_int(ratio("total_sales", "tables"))).withColumn(
        "day_kind", weekday_flag("sale_date")
    )


def order_grain(lines: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Lines summed to orders, so that later distinct counts see far fewer rows."""
    return lines.groupBy(*keys, "order_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def store_platform_daily(lines: DataFrame) -> DataFrame:
    """Orders, sums, opening date, platform list and revenue per order of a store day."""
    g = order_grain(
        lines, ["sale_date", "store", "manager", "platform", "open_date"],
        {"_a": "total_price", "_s": "settlement_amount"},
    )
    return (
        g.groupBy("sale_date", "store", "manager")
        .agg(
            F.countDistinct("order_id").alias("total_order_count"),
            F.sum("_a").alias("total_amount"),
            F.sum("_s").alias("settlement_amount"),
            F.min("open_date").alias("open_date"),
            joined_set("platform").alias("platform"),
        )
        .withColumn("arpu", rnd(ratio("total_amount", "total_order_count"), 4))
    )


def platform_pivot(lines: DataFrame, platforms: Sequence[str]) -> DataFrame:
    """Four metrics x platform as columns, zeros where a platform has no orders."""
    g = order_grain(
        lines, ["sale_date", "store", "platform"],
        {"_a": "total_price", "_f": "discount_amount", "_s": "settlement_amount"},
    )
    wide = g.groupBy("sale_date", "store").pivot("platform", list(platforms)).agg(
        F.countDistinct("order_id").alias("orders"), F.sum("_a").alias("amount"),
        F.sum("_f").alias("fee"), F.sum("_s").alias("settlement"),
    )
    names = {f"{p}_{m}": f"{m}_{p}" for p in platforms for m in ("orders", "amount", "fee", "settlement")}
    return wide.withColumnsRenamed(names).fillna(0, list(names.values()))


def manager_daily(lines: DataFrame) -> DataFrame:
    """Sums, stores, orders, platforms and revenue per order of a manager day."""
    g = order_grain(
        lines, ["sale_date", "manager", "store", "platform"], {"_a": "total_price", "_s": "settlement_amount"}
    )
    return (
        g.groupBy("sale_date", "manager")
        .agg(
            F.sum("_a").alias("total_amount"), F.sum("_s").alias("settlement_amount"),
            # Sets of stores and platforms are small; only the order ids need a distinct count.
            F.size(F.collect_set("store")).alias("store_count"), joined_set("platform").alias("platform"),
            F.countDistinct("order_id").alias("total_order_count"),
        )
        .withColumn("arpu", rnd_int(ratio("total_amount", "total_order_count")))
    )


def event_pivot(events: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Number of change events per day, store and category, wide."""
    return events.groupBy("d", "store").pivot("event_type", list(kinds)).count().fillna(0, list(kinds))


def ops_change_flags(events: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """1 when a change of the kind happened on the day, with the day's first event id."""
    return events.groupBy("d", "store").agg(
        *[F.max(F.when(F.col("event_type") == k, 1).otherwise(0)).alias(f"{k}_flag") for k in kinds],
        F.min("event_id").alias("first_event_id"),
    )


def bid_change_stats(bids: DataFrame, stat_cols: Sequence[str]) -> DataFrame:
    """Latest bid per store day with the week's min, max and mean of each bid column."""
    week = F.date_trunc("week", "d").cast("date")
    g = bids.withColumn("week_start", week).groupBy("store", "week_start")
    aggs = []
    for c in stat_cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), rnd(F.avg(c), 2).alias(f"{c}_mean")]
    latest = keep_one(bids, ["store", "d"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.withColumn("week_start", week).join(g.agg(*aggs), ["store", "week_start"], "left")


def mean_excluding_zero(c) -> Column:
    """Mean of the positive values, 0 when there are none."""
    return F.coalesce(F.avg(F.when(col(c) > 0, col(c))), F.lit(0.0))


def hall_daily_kpi(lines: DataFrame, order_types: Sequence[str]) -> DataFrame:
    """Orders, revenue and ticket size per day and order type, cancelled lines left out."""
    kept = lines.where(
        F.trim("order_type").isin(list(order_types)) & (F.col("sale_type") != "취소") & (F.col("order_id") != "")
    )
    return (
        order_grain(kept, ["sale_date", "order_type"], {"_a": "total_price"})
        .groupBy("sale_date", "order_type")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("_a").alias("sales"))
        .withColumn("ticket", F.coalesce(rnd(ratio("sales", "orders"), 2), F.lit(0.0)))
    )


def hall_weekly_slots(lines: DataFrame, as_of, amount="total_price", orders="order_cnt") -> DataFrame:
    """Completed weeks split by month: totals, lunch and dinner with ticket size, zero filled."""
    slots = {"": F.lit(True), "lunch_": F.col("time_slot") == "점심", "dinner_": F.col("time_slot") == "저녁"}
    aggs = []
    for p, cond in slots.items():
        aggs += [
            F.coalesce(F.sum(F.when(cond, F.col(amount))), F.lit(0)).alias(f"{p}sales"),
            F.coalesce(F.sum(F.when(cond, F.col(orders))), F.lit(0)).alias(f"{p}orders"),
        ]
    week = F.date_trunc("week", "sale_date").cast("date")
    g = lines.groupBy("ym", week.alias("week_start")).agg(*aggs)
    g = g.withColumns(
        {
            f"{p}ticket": F.when(F.col(f"{p}orders") > 0, rnd_int(ratio(f"{p}sales", f"{p}orders"))).otherwise(0)
            for p in slots
        }
    )
    return g.where(F.date_add("week_start", 6) < F.lit(as_of).cast("date"))


def review_dedup(reviews: DataFrame, id_less: str, id_key: Sequence[str], other_key: Sequence[str], order) -> DataFrame:
    """Rows of the id-less channel are unique by content, all others by id."""
    plain = F.col("channel") == id_less
    a = keep_one(reviews.where(plain), list(other_key), order)
    b = keep_one(reviews.where(~plain | F.col("channel").isNull()), list(id_key), order)
    return b.unionByName(a)


def fill_target_day(df: DataFrame, day: str, target) -> DataFrame:
    """If the target day has no row, repeat the day before under the target date."""
    t = F.lit(target).cast("date")
    if not df.where(F.col(day) == t).isEmpty():
        return df
    return df.unionByName(df.where(F.col(day) == F.date_sub(t, 1)).withColumn(day, t))


def review_topic_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("d", "store", "topic", "sentiment").agg(F.count("doc_id").alias("mentions"))


def review_daily_counts(reviews: DataFrame, id_less: str) -> DataFrame:
    """Distinct reviews per day and channel; the id-less channel counts rows."""
    plain = F.col("channel") == id_less
    by_id = reviews.where(~plain).groupBy("d", "store", "channel").agg(F.countDistinct("doc_id").alias("reviews"))
    by_row = reviews.where(plain).groupBy("d", "store", "channel").agg(F.count(F.lit(1)).alias("reviews"))
    return by_id.unionByName(by_row)


def voc_store_summary(reviews: DataFrame, review_key: Column) -> DataFrame:
    """Distinct reviews and negative ones per day, manager and store, with 30-row sums and their change."""
    once = reviews.groupBy("d", "manager", "store", review_key.alias("_rk")).agg(
        F.max(F.when(F.col("sentiment") == "negative", 1).otherwise(0)).alias("_neg")
    )
    g = once.groupBy("d", "manager", "store").agg(F.count(F.lit(1)).alias("reviews"), F.sum("_neg").alias("negatives"))
    keys = ["manager", "store"]
    g = g.withColumn("sum_30d_recent", trunc_int(s.rolling(F.sum, "negatives", keys, "d", -29))).withColumn(
        "sum_30d_prev", trunc_int(s.rolling(F.sum, "negatives", keys, "d", -59, -30))
    )
    return g.withColumn("pct_change_30d", pct("sum_30d_recent", "sum_30d_prev", 4))


def voc_topic_negatives(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("sentiment") == "negative").groupBy("d", "store", "topic").agg(
        F.count(F.lit(1)).alias("negatives")
    )


def last_known(c, order: str) -> Column:
    """Last non-null value of a column by ``order``."""
    return F.max_by(col(c), F.when(col(c).isNotNull(), F.col(order)))


DONE = "완료"


def cs_issue_mart(rows: DataFrame, attrs: Sequence[str], as_of, fixed_before: int = 0) -> DataFrame:
    """One row per ticket from its collected snapshots."""
    memo = F.length(F.trim(F.coalesce("memo", F.lit("")))) > 0
    done = F.col("status") == DONE
    g = rows.where(F.length(F.trim("ticket")) > 0).groupBy("ticket").agg(
        *[last_known(a, "uploaded_at").alias(a) for a in [*attrs, "status"]],
        F.min("registered").alias("registered"),
        F.min(F.when(done, F.col("uploaded_at"))).cast("date").alias("_done_upload"),
        F.min(F.when(memo, F.col("collected"))).alias("first_memo"),
    )
    end = F.coalesce("first_memo", F.lit(as_of).cast("date"))
    days = F.greatest(F.datediff(end, "registered"), F.lit(0))
    known = F.coalesce(F.col("ticket").try_cast("bigint") >= fixed_before, F.lit(True))
    return g.withColumns(
        {
            "is_done": F.when(F.col("status") == DONE, 1).otherwise(0),
            "done_date": F.when(F.col("status") == DONE, F.coalesce("first_memo", "_done_upload")),
            "duration_days": F.when(known, days),
            "month": F.date_format("registered", "yyyy-MM"),
            "month_label": F.date_format("registered", "MMM-yy"),
            "month_sort": F.year("registered") * 100 + F.month("registered"),
        }
    ).drop("_done_upload")


def cs_month_stats(mart: DataFrame, issue: str = "issue_type", top: int = 3) -> DataFrame:
    """Tickets, done share, mean days and the most frequent issue types per month."""
    base = mart.groupBy("month").agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_done").alias("done"),
        rnd(F.avg("duration_days"), 1).alias("avg_days"),
    )
    counts = mart.where(F.col(issue).isNotNull()).groupBy("month", issue).agg(F.count(F.lit(1)).alias("_n"))
    best = top_k(counts, ["month"], [F.col("_n").desc(), F.col(issue)], top)
    text = F.concat(F.col(issue), F.lit("("), F.col("_n").cast("string"), F.lit("건)"))
    tops = best.groupBy("month").agg(F.array_sort(F.collect_list(F.struct("_rank", text.alias("t")))).alias("_l"))
    tops = tops.select("month", F.array_join(F.transform("_l", lambda x: x["t"]), ", ").alias("issue_types"))
    return (
        base.join(tops, "month", "left")
        .withColumn("done_rate", rnd_int(ratio("done", "total") * 100))
        .withColumn("issue_types", F.coalesce("issue_types", F.lit("-")))
    )


def cs_daily_completion(rows: DataFrame) -> DataFrame:
    """Done / total per collect day and mean response days from registration to the first memo."""
    memo = F.length(F.trim(F.coalesce("memo", F.lit("")))) > 0
    first = rows.groupBy("ticket").agg(
        F.min("registered").alias("_reg"), F.min(F.when(memo, F.col("collected"))).alias("_memo")
    )
    answered = first.where(F.col("_memo").isNotNull()).groupBy(F.col("_memo").alias("collected")).agg(
        rnd(F.avg(F.greatest(F.datediff("_memo", "_reg"), F.lit(0))), 2).alias("avg_response_days")
    )
    once = rows.groupBy("collected", "ticket").agg(F.max(F.when(F.col("status") == DONE, 1).otherwise(0)).alias("_done"))
    daily = once.groupBy("collected").agg(F.count(F.lit(1)).alias("total"), F.sum("_done").alias("done"))
    return daily.join(answered, "collected", "left").withColumn("done_rate", share_pct("done", "total", 1))


def closing_rate_kpi(grid: DataFrame) -> DataFrame:
    """Active, new and closed stores per month with the closing rate."""
    g = grid.groupBy("ym").agg(
        F.sum("is_active").alias("active_count"), F.sum("is_new").alias("new_open"), F.sum("is_closed").alias("closed")
    )
    return g.withColumn("closing_rate", F.coalesce(rnd(ratio("closed", "active_count"), 4), F.lit(0.0)))


def ranked(keys: Sequence[str], value: str) -> Column:
    return F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).desc()))


def menu_store_agg(sales: DataFrame, period: str = "ym") -> DataFrame:
    """Store x menu sums with the all-store mean and the store's rank for the menu."""
    g = sales.groupBy(period, "store", "menu", "category").agg(
        F.sum("qty").alias("store_qty"), F.sum("sales").alias("store_sales")
    )
    # A menu's rows are one per store by now, so its window is bounded by the stores.
    peers = Window.partitionBy(period, "menu")
    return g.withColumns(
        {
            "avg_qty": rnd(F.avg("store_qty").over(peers), 4), "avg_sales": rnd(F.avg("store_sales").over(peers), 4),
            "stores": F.size(F.collect_set("store").over(peers)),
            "qty_rank": ranked([period, "menu"], "store_qty"),
            "sales_rank": ranked([period, "menu"], "store_sales"),
        }
    )


def menu_store_summary(store_menu: DataFrame, period: str = "ym") -> DataFrame:
    """Store totals, menu count and the best menu by quantity and by revenue."""
    keys = [period, "store"]
    g = store_menu.groupBy(*keys).agg(
        F.sum("store_qty").alias("total_qty"), F.sum("store_sales").alias("total_sales"),
        F.countDistinct("menu").alias("menus"),
        F.max(F.struct("store_qty", "store_sales", "menu", "category")).alias("_q"),
        F.max(F.struct("store_sales", "store_qty", "menu", "category")).alias("_s"),
    )
    return g.select(
        *keys, "total_qty", "total_sales", "menus", F.count(F.lit(1)).over(Window.partitionBy(period)).alias("stores"),
        F.col("_q.menu").alias("top_qty_menu"), F.col("_q.store_qty").alias("top_qty"),
        F.col("_s.menu").alias("top_sales_menu"), F.col("_s.store_sales").alias("top_sales"),
        ranked([period], "total_qty").alias("qty_rank"), ranked([period], "total_sales").alias("sales_rank"),
    )


def menu_total_agg(sales: DataFrame, period: str = "ym") -> DataFrame:
    """Menu totals with rank overall and in the category, and the share of the category."""
    g = sales.groupBy(period, "menu", "category").agg(F.sum("qty").alias("qty"), F.sum("sales").alias("sales"))
    cat = Window.partitionBy(period, "category")
    return (
        g.withColumns({"_cq": F.sum("qty").over(cat), "_cs": F.sum("sales").over(cat)})
        .withColumns(
            {
                "qty_rank": ranked([period], "qty"), "sales_rank": ranked([period], "sales"),
                "cat_qty_rank": ranked([period, "category"], "qty"),
                "cat_sales_rank": ranked([period, "category"], "sales"),
                "cat_qty_share": share_pct("qty", "_cq"), "cat_sales_share": share_pct("sales", "_cs"),
            }
        )
        .drop("_cq", "_cs")
    )


def menu_month_category(sales: DataFrame) -> DataFrame:
    """Sales per month and category, with and without the store, from one aggregate (store null = all)."""
    return (
        sales.rollup("ym", "category", "store").agg(F.sum("sales").alias("sales"), F.grouping_id().alias("_g"))
        .where(F.col("_g") <= 1).drop("_g")
    )


def ad_weekly_funnel(events: DataFrame) -> DataFrame:
    """Weekly spend, impressions, clicks, orders and revenue with CTR, CVR, ROAS and their change."""
    is_ = lambda k: F.col("event_type") == k
    money = lambda k: F.coalesce(F.sum(F.when(is_(k), F.col("amount"))), F.lit(0))
    g = events.groupBy("store", F.date_trunc("week", "d").cast("date").alias("week_start")).agg(
        money("click").alias("spend"), F.count(F.when(is_("view"), 1)).alias("impressions"),
        F.count(F.when(is_("click"), 1)).alias("clicks"), F.count(F.when(is_("purchase"), 1)).alias("orders"),
        money("purchase").alias("revenue"),
    )
    g = g.withColumns(
        {
            "ctr": rnd(ratio("clicks", "impressions") * 100, 2), "cvr": rnd(ratio("orders", "clicks") * 100, 2),
            "roas": rnd(ratio("revenue", "spend") * 100, 2),
        }
    )
    w = Window.partitionBy("store").orderBy("week_start")
    return g.withColumns(
        {f"{c}_wow_pct": pct(F.col(c), F.lag(c).over(w), 1) for c in ("spend", "clicks", "orders", "revenue")}
    )


def low_weekdays(daily: DataFrame, k: int = 2) -> DataFrame:
    """The weekdays with the lowest mean orders of each store."""
    g = daily.groupBy("store", F.weekday("sale_date").alias("weekday")).agg(rnd(F.avg("orders"), 4).alias("avg_orders"))
    return top_k(g, ["store"], ["avg_orders", "weekday"], k, rank="rank")


def first_sale_date(lines: DataFrame) -> DataFrame:
    return lines.groupBy("source", "item_id").agg(F.min("sale_date").alias("first_sale_date"))


def launch_dates(first_sales: DataFrame, master_dates: DataFrame) -> DataFrame:
    """Launch = first sale, else the first master date; keys of both sides are kept."""
    j = first_sales.join(master_dates, ["source", "item_id"], "full")
    return j.select("source", "item_id", F.coalesce("first_sale_date", "first_master_date").alias("launch_date"))


def label_conflicts(labels: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """Keys that carry more than one label, with the labels."""
    g = labels.groupBy(*key, label).agg(F.lit(1).alias("_x")).groupBy(*key).agg(
        F.count(F.lit(1)).alias("label_count"), joined_set(label, "|").alias("labels")
    )
    return g.where(F.col("label_count") > 1)


def flag_conflicts(rows: DataFrame, conflicts: DataFrame, key: Sequence[str]) -> DataFrame:
    c = conflicts.select(*key, F.lit("Y").alias("_c"))
    return rows.join(c, list(key), "left").withColumn("conflict", F.coalesce("_c", F.lit("N"))).drop("_c")


def most_common(cells: DataFrame, keys: Sequence[str], value: str, out: str, weight: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest one on ties."""
    n = cells.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_n"))
    return keep_one(n, keys, [F.col("_n").desc(), F.col(value)]).select(*keys, F.col(value).alias(out))


def item_evidence(lines: DataFrame, keys: Sequence[str], menu: str, top: int = 5) -> DataFrame:
    """Modal brand and price of an item, the menus it appears in (blank ones left out), the most frequent of them, and whether it is the only one."""
    # One pass over the lines; all evidence comes from this small table.
    named = F.nullif(F.trim(F.col(menu).cast("string")), F.lit(""))
    cells = stage(lines.withColumn(menu, named).groupBy(*keys, menu, "brand", "unit_price").agg(F.count(F.lit(1)).alias("_c")))
    counts = cells.groupBy(*keys, menu).agg(F.sum("_c").alias("_n"))
    base = counts.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.count(menu).alias("menu_count"))
    best = top_k(counts.where(F.col(menu).isNotNull()), keys, [F.col("_n").desc(), F.col(menu)], top)
    names = best.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_rank", F.col(menu).alias("t")))).alias("_l"))
    names = names.select(
        *keys, F.get(F.col("_l"), F.lit(0))["t"].alias("representative_menu"), F.array_join(F.transform("_l", lambda x: x["t"]), " | ").alias("menu_sample")
    )
    brand = most_common(cells, keys, "brand", "common_brand", "_c")
    price = most_common(cells, keys, "unit_price", "common_price", "_c")
    out = base.join(names, list(keys), "left").join(brand, list(keys), "left").join(price, list(keys), "left")
    sure = F.when(F.col("menu_count") == 1, "high").when(F.col("menu_count") > 1, "low").otherwise("")
    blank = {c: F.coalesce(c, F.lit("")) for c in ("representative_menu", "menu_sample")}
    return out.withColumns(blank).withColumn("confidence", sure)


def sheet_group_sum(df: DataFrame, group: str, total_label: str = "합계") -> DataFrame:
    """Sum of all numeric columns per group, the sheet's own total row left out."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != group]
    return df.where(F.trim(group) != total_label).groupBy(group).agg(*[F.sum(c).alias(c) for c in nums])


def coverage_summary(df: DataFrame, keys: Sequence[str], null_cols: Sequence[str]) -> DataFrame:
    """Row count and null share of columns per partition key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[rnd(F.avg(F.col(c).isNull().cast("double")), 4).alias(f"{c}_null_rate") for c in null_cols],
    )


def coupon_flag(lines: DataFrame, order: str, coupon: str) -> DataFrame:
    """Y on every line of an order with a coupon on any line."""
    used = lines.groupBy(order).agg(F.max(F.col(coupon)).alias("_c"))
    return lines.join(used, order, "left").withColumn(
        "coupon_yn", F.when(F.coalesce("_c", F.lit(0)) > 0, "Y").otherwise("N")
    ).drop("_c")


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str, rename=None) -> DataFrame:
    """Unpivot, drop blanks, rename the categories, and sum those that became equal."""
    long = df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull() & (F.col(value) != 0))
    if rename:
        pairs = [F.lit(x) for kv in rename.items() for x in kv]
        long = long.withColumn(name, F.coalesce(F.element_at(F.create_map(*pairs), F.col(name)), F.col(name)))
    return long.groupBy(*ids, name).agg(F.sum(value).alias(value))


def input_completeness(daily: DataFrame, stores: DataFrame, as_of, metrics: Sequence[str], days: int = 7) -> DataFrame:
    """Expected (store, day) of the last days without a row, or with all metrics 0."""
    hi = F.date_sub(F.lit(as_of).cast("date"), 1)
    grid = stores.select("store", F.explode(F.sequence(F.date_sub(F.lit(as_of).cast("date"), days), hi)).alias("sale_date"))
    got = daily.select("store", "sale_date", *metrics).withColumn("_row", F.lit(1))
    zero = F.lit(True)
    for m in metrics:
        zero = zero & (F.coalesce(F.col(m), F.lit(0)) == 0)
    issue = F.when(F.col("_row").isNull(), "missing").when(zero, "all_zero")
    return grid.join(got, ["store", "sale_date"], "left").withColumn("issue", issue).where(
        F.col("issue").isNotNull()
    ).select("store", "sale_date", "issue")


def collection_status(stores: DataFrame, platforms: Sequence[str], got: DataFrame) -> DataFrame:
    """Manager summary of the store x platform grid: collected, missing, and which are missing."""
    grid = stores.select("manager", "store", F.explode(F.array(*[F.lit(p) for p in platforms])).alias("platform"))
    seen = got.select("store", "platform").distinct().withColumn("_got", F.lit(1))
    j = grid.join(seen, ["store", "platform"], "left")
    miss = F.when(F.col("_got").isNull(), F.concat_ws(":", "store", "platform"))
    return j.groupBy("manager").agg(
        F.count(F.lit(1)).alias("expected"), F.count("_got").alias("collected"),
        F.count(miss).alias("missing"), joined_set(miss).alias("missing_list"),
    )
