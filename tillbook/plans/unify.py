"""Raw exports of each source to the unified sales lines.

Every function takes whole tables (any number of days) and returns the unified
columns. Order-level steps run through ``by_heat``: ordinary orders in windows
over one shuffle, hot order keys apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import clean as c
from tillbook.functions.keys import sub_order_id, unified_pk
from tillbook.functions.numbers import ratio, rnd_int
from tillbook.functions.rules import DELIVERY, DELIVERY_PACK, HALL, HALL_PACK, HALL_TABLE, PACK, mapped, order_type_classify, platform_revenue, reclassify_by_order, signed_amount
from tillbook.operators import order_lines as o
from tillbook.operators.core import AUTO, attach, by_heat, hot_and_rows, hot_counts, keep_one, resolve_hot, slice_count, slices
from tillbook.operators.filters import exclude_overlapping_stores, store_scoped_blacklist
from tillbook.operators.joins import code_to_name_map, dim_enrich, heads_with_lines, last_two_tokens
from tillbook.session import stage, stage_all

CANCELLED, NORMAL = "취소", "정상"
UNIFIED = [
    "sale_date", "ym", "source", "brand", "store", "region", "manager", "open_date", "platform", "order_type",
    "order_id", "order_time", "menu_name", "item_seq", "item_id", "item_name", "qty", "unit_price", "total_price",
    "discount_amount", "sale_type", "_pk", "order_cnt",
]


ATTRS = ["region", "manager", "open_date"]


def finish(df: DataFrame, stores: DataFrame, source: str, brand: Column | str, one_store: str | None = None) -> DataFrame:
    """Source, month, store attributes and key; unified columns in order.

    With ``one_store`` all rows are of that store and its attributes are scalar subqueries.
    """
    brand = F.lit(brand) if isinstance(brand, str) else brand
    df = df.withColumns({"source": F.lit(source), "brand": brand, "ym": F.date_format("sale_date", "yyyy-MM")}).drop(*ATTRS)
    if one_store is None:
        df = dim_enrich(df, stores, "store", "store", ATTRS)
    else:
        one = stores.where(F.col("store") == one_store)
        df = df.withColumns({a: one.select(F.max(a)).scalar() for a in ATTRS})
    return df.withColumn("_pk", unified_pk()).select(*UNIFIED)


def is_cancelled() -> Column:
    return F.col("sale_type") == CANCELLED


def _hot_and_slices(rows: DataFrame, keys: Sequence[str], hot, times: int, wider=None) -> tuple[DataFrame | None, int]:
    """(hot keys, number of slices) for rows shuffled so many times; rows whose hot keys are given are not counted and go in one.

    ``wider`` follows from the keys and is cheaper to count: if none of its values is hot, no key is.
    """
    if not isinstance(hot, str) or hot != AUTO:
        return hot, 1
    sizes = lambda by: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    hot, n = hot_and_rows(sizes(keys if wider is None else [F.xxhash64(wider).alias("_w")]))
    if wider is not None and hot is not None:
        hot, n = hot_and_rows(sizes(keys))
    return hot, slice_count(rows.sparkSession, n, times)


def _bare_id(x) -> Column:
    """Equal for ids that ``normalize_id`` makes equal, without its patterns: the text without leading zeros."""
    return F.ltrim(c.text(x), F.lit("0"))


def _finish_slices(parts, n: int, stores: DataFrame, source: str, brand: Column | str) -> DataFrame:
    """``finish`` of the lines of all slices; with more than one these are written first, and the stores, whose size is known then."""
    return finish(stage_all(parts), stage(stores), source, brand) if n > 1 else finish(next(parts), stores, source, brand)


# -- POS receipts -------------------------------------------------------------


@by_heat
def _receipt_lines(rows: DataFrame, keys: Sequence[str], line_order: Sequence, hot=AUTO):
    rows = o.item_seq(rows, keys, line_order, hot=hot)
    price = F.when(F.col("qty") > 0, ratio("amount", "qty")).otherwise(F.col("amount"))
    rows = rows.withColumns({"unit_price": rnd_int(price), "total_price": F.col("amount")})
    rows = rows.withColumns({m: signed_amount(m, is_cancelled()).cast("bigint") for m in ("total_price", "discount_amount")})
    # The values of all steps in a receipt are attached in one pass.
    values = {**o.time_values(), **o.last_line_values(), **o.balance_values("actual_amount"), "_paid": F.sum(F.when(F.col("item_id") == o.ADJUST_ID, 0).otherwise(F.col("amount")))}
    rows = o.main_item_segments(rows, keys, F.col("is_main") == "Y", price, F.col("hall"), line_order=line_order, also=values, hot=hot)
    rows = o.order_time_unify(rows, keys, attached=True, hot=hot)
    rows = o.order_cnt_last_line(rows, keys, attached=True, hot=hot)
    return o.adjustment_rows(rows, keys, "actual_amount", attached=True, hot=hot)


def unify_receipts(
    heads: DataFrame, items: DataFrame, stores: DataFrame, master: DataFrame, line_order: Sequence[str],
    counter: Sequence[str], phone: str, source: str = "pos_a", brand: str = "", hot=AUTO,
) -> DataFrame:
    """POS receipt headers and lines to unified lines, with balancing lines and inherited refund names."""
    keys = ["receipt_no", "pos_no", "store", "sale_date"]  # the most telling one first: sorts compare its head only
    norm = lambda df: df.withColumns(
        {"store": c.text("store"), "pos_no": c.normalize_id("pos_no"), "receipt_no": c.normalize_id("receipt_no"), "_cut": _bare_id("receipt_no")}
    )
    heads, items = norm(heads), norm(items)
    hot, n = _hot_and_slices(items, keys, hot, 3, "_cut")
    # What follows from the header alone is found before its lines multiply it.
    table, kind = c.text("table_name"), c.text("order_kind")
    hall = (table.rlike(r"^\d+$") | table.contains(PACK)) & ~table.contains(DELIVERY) | (
        kind.rlike(f"{HALL}|{PACK}|매장") & ~kind.contains(DELIVERY)
    )
    platform, order_type = order_type_classify("channel", "order_kind", "table_name", counter, phone)
    heads = heads.select(
        *keys, "_cut", "actual_amount", c.normalize_time("order_time").alias("order_time"), hall.alias("hall"), platform.alias("platform"),
        order_type.alias("order_type"), F.when(F.trim("kind") == "반품", CANCELLED).otherwise(NORMAL).alias("sale_type"),
    )
    # The master is joined once, to the lines of the export; blank and balancing ids come later and are looked up singly.
    main = (F.col("is_main_candidate") == "Y") & (F.coalesce("exclude_check", F.lit("N")) != "Y")
    named = master.groupBy(F.col("code").alias("item_id")).agg(
        F.max(F.when(main, "Y")).alias("is_main"), F.min(F.struct("name")).alias("_n")
    ).withColumn("_n", F.col("_n.name"))
    one_name = lambda code: master.where(F.col("code") == code).agg(F.min(F.struct("name")).alias("_n")).select("_n.name").scalar()

    def lines(heads, items):
        rows = heads_with_lines(heads, items.join(named, "item_id", "left"), keys, hot=hot)
        rows = rows.withColumns(
            {
                "item_id": F.coalesce("item_id", F.lit("")), "qty": F.coalesce("qty", F.lit(0)),
                # A header without lines (a refund) counts with its own amount.
                "amount": F.coalesce("amount", F.abs("actual_amount")), "discount_amount": F.coalesce("discount_amount", F.lit(0)),
            }
        )
        return _receipt_lines(rows, keys, line_order, hot=hot).drop(*line_order, "is_main", "hall", "actual_amount", "amount")

    parts = (lines(*x) for x in slices([heads, items], "_cut", n, ["_cut"]))
    rows = stage_all(parts) if n > 1 else stage(next(parts))
    # Refunds without lines take the name of an order with the same amount that day, else of the same receipt.
    rows = inherit_refund_names(rows, keys, "_paid")
    has_time = F.col("order_time") != ""
    name = F.when(F.col("item_id") == o.ADJUST_ID, one_name(o.ADJUST_ID)).when(F.col("item_id") == "", one_name("")).otherwise(F.col("_n"))
    rows = rows.withColumns(
        {
            "order_id": F.concat(
                F.element_at(F.split("store", " "), -1), F.lit("_"), "pos_no", F.when(has_time, "-").otherwise("_"), "receipt_no",
                F.lit("_"), F.when(has_time, F.col("order_time")).otherwise("00:00:00"),
            ),
            "item_name": F.coalesce(name, "item_name", F.lit("")), "menu_name": F.coalesce("menu_name", F.lit("")),
        }
    )
    return finish(rows, stores, source, brand)


def inherit_refund_names(rows: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """Menu names for orders without one: those of an order with the same amount that day, else of the same receipt number.

    ``total`` is the sum of an order on all its lines. Only lines without a name meet the orders, all others stay where they are.
    """
    receipt, pos, store, day = keys
    orders = rows.where(F.col(o.SEQ) == 1).select(*keys, F.col("menu_name").alias("_m"), F.abs(total).alias("_t"))
    named = orders.where(F.col("_m").isNotNull())
    by_amount = keep_one(named.where(F.col("_t") > 0), [day, store, "_t"], [pos, receipt]).select(
        day, store, "_t", F.col("_m").alias("_a")
    )
    by_receipt = keep_one(named, [store, pos, receipt], [day]).select(store, pos, receipt, F.col("_m").alias("_b"))
    refunds = orders.where(F.col("_m").isNull()).drop("_m")
    found = refunds.join(by_amount, [day, store, "_t"], "left").join(by_receipt, [store, pos, receipt], "left").select(
        *keys, F.coalesce("_a", "_b").alias("_found")
    )
    blank = rows.where(F.col("menu_name").isNull()).join(found, list(keys), "left").withColumn("menu_name", F.col("_found"))
    return rows.where(F.col("menu_name").isNotNull()).unionByName(blank.select(*rows.columns))


# -- delivery feed ------------------------------------------------------------


@by_heat
def _feed_amounts(rows: DataFrame, keys, hot=AUTO):
    return o.proportional_allocation(rows, keys, "amount", "revenue", "total_price", hot=hot)


@by_heat
def _feed_best(rows: DataFrame, keys, hot=AUTO):
    return o.representative_row(rows, keys, "unit_price", hot=hot)


def unify_delivery_feed(*args, **kw) -> tuple[DataFrame, DataFrame]:
    """(unified lines, lines removed by the black list), see ``delivery_feed``."""
    return delivery_feed(*args, **kw)[:2]


def delivery_feed(
    orders: DataFrame, items: DataFrame, stores: DataFrame, blacklist: DataFrame, line_order: Sequence[str],
    platforms: dict[str, str], complete: Sequence[str], revenue_rules: dict, source: str = "feed", hot=AUTO,
    aliases: DataFrame | None = None, brands: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(unified lines, lines removed by the black list, hot order ids or None). Orders without lines are left out.

    Old store names (``aliases``: old, new) are replaced and brand prefixes cut off before anything is keyed by the store.
    """
    if aliases is not None:
        orders = c.store_alias_normalize(orders.withColumn("store", c.text("store")), aliases, "store", brands).drop("store_key")
    if brands:
        orders = orders.withColumn("store", c.strip_brand("store", brands))
    code = lambda x: F.coalesce(c.text(x).try_cast("bigint"), F.lit(0)).cast("string")
    heads = orders.withColumns(
        {
            "order_code": code("order_code"),
            "revenue": platform_revenue("path", "order_kind", "total", "fee", "discount", "paid", "address", **revenue_rules),
            "order_type": F.when(F.col("order_kind").contains(PACK), DELIVERY_PACK).otherwise(DELIVERY),
            "platform": mapped("path", platforms),
            "sale_type": F.when(F.col("status").isin(list(complete)), NORMAL).otherwise(CANCELLED),
            "order_id": F.coalesce(
                c.blank_to_null("external_no"), F.concat_ws("_", F.lit("tmp"), c.text("store"), c.text("order_time"))
            ),
            "order_time": c.normalize_time("order_time"), "head_menu": F.coalesce("menu", F.lit("")),
        }
    )
    items = items.withColumn("order_code", code("order_code")).where(c.text("item_name") != "")
    rows = heads.join(items, "order_code")
    # Orders without an external number share a surrogate id, so hot ids are counted on the joined keys.
    codes = hot
    if isinstance(hot, str) and hot == AUTO:  # lines are counted by code before the headers name the orders
        per_code = items.groupBy("order_code").agg(F.count(F.lit(1)).alias("_n"))
        named = heads.select("order_code", "order_id").join(per_code, "order_code").groupBy("order_id")
        hot = hot_counts(named.agg(F.sum("_n").alias("_n")))
        codes = None if hot is None else AUTO  # an order has all lines of its codes: without hot orders no code is hot
    rows = _feed_amounts(rows, ["order_code"], hot=resolve_hot(items.select("order_code"), ["order_code"], codes))
    rows = o.item_seq(rows, ["order_id"], line_order, hot=hot)
    name = F.ltrim(c.text("item_name"), F.lit("'+ "))
    rows = rows.withColumns(
        {
            "discount_amount": F.greatest(F.col("amount") - F.col("total_price"), F.lit(0)),
            "total_price": F.when(is_cancelled(), -F.abs("total_price")).otherwise(F.col("total_price")),
            "item_name": name, "item_id": F.when(name != "", F.md5(name)).otherwise(""),
        }
    )
    rows = reclassify_by_order(
        rows, "order_id", F.col("item_name").contains(f"{HALL}_"), {"platform": F.lit(HALL), "order_type": F.lit(HALL_TABLE)}, hot=hot
    )
    key = c.item_key("item_name")
    kept = _feed_best(store_scoped_blacklist(rows, blacklist, key), ["order_id"], hot=hot)
    kept = kept.withColumn("menu_name", F.coalesce(F.nullif("menu_name", F.lit("")), "head_menu"))
    return finish(kept, stores, source, F.col("brand")), store_scoped_blacklist(rows, blacklist, key, removed=True), hot


def recalculate_order_fields(lines: DataFrame, hot=AUTO) -> DataFrame:
    """Menu name, order count and key again after lines were taken out of the fact.

    ``hot`` may be the hot orders of the fact before: counting them again would run the whole fact twice.
    """
    out = o.representative_row(lines.drop("menu_name", "order_cnt", "_pk"), ["order_id"], "unit_price", hot=hot)
    return out.withColumn("_pk", unified_pk()).select(*UNIFIED)


# -- union POS ----------------------------------------------------------------


@by_heat
def _union_lines(rows: DataFrame, keys, line_order, hot=AUTO):
    rows = o.item_seq(rows, keys, line_order, hot=hot)
    counted = F.when(F.col("item_name") != "", F.abs("unit_price")).otherwise(0)
    values = {"_pack": F.max("pack"), **o.representative_values(counted)}
    rows = o.main_item_segments(
        rows, keys, F.col("is_main") == "Y", F.abs("unit_price"), None, paid_dish=True, line_order=line_order, also=values, hot=hot
    )
    return o.representative_row(rows, keys, counted, set_menu=False, attached=True, hot=hot)


# Sale types of the union POS export.
UNION_TYPES = ("판매", "판매(반)", "반품")


def unify_union_pos(
    heads: DataFrame, items: DataFrame, stores: DataFrame, master: DataFrame, line_order: Sequence[str],
    source: str = "union", brand: str = "", hot=AUTO,
) -> DataFrame:
    """Receipts whose option lines carry no amount; hall only; lines without meaning are dropped."""
    kind = c.text("item_sale_type")
    items = items.where((kind == "") | kind.isin(*UNION_TYPES)).withColumns(
        {
            "receipt_no": c.normalize_id("receipt_no"), "_no": _bare_id("receipt_no"), "item_id": c.normalize_id("item_id"),
            "unit_price": F.when(kind.isin(*UNION_TYPES), c.money_to_int("amount")).otherwise(0),
            "pack": F.coalesce("category", F.lit("")).contains(PACK) | F.coalesce("item_name", F.lit("")).contains(PACK),
            "item_name": F.trim(F.regexp_replace(c.text("item_name"), r"^[┗└\s]+", "")),
        }
    )
    items = items.withColumn("item_name", F.when(F.col("item_name").rlike(r"^\([^)]*\)$"), "").otherwise(F.col("item_name")))
    heads = heads.where(c.text("sale_type").isin(*UNION_TYPES)).withColumns(
        {"receipt_no": c.normalize_id("receipt_no"), "_no": _bare_id("receipt_no"), "pos_no": c.normalize_id("pos_no")}
    )
    # What follows from the header alone is found before its lines multiply it.
    heads = heads.withColumns(
        {
            "order_id": F.concat_ws("_", "pos_no", "receipt_no", "sold_at"), "order_time": c.normalize_time("sold_at"),
            "sale_type": F.when(F.col("sale_type").contains("반품"), CANCELLED).otherwise(NORMAL),
        }
    )
    main = master.where((F.col("is_main_candidate") == "Y") & (F.col("exclude_check") != "Y"))
    main = main.select(F.col("code").alias("item_id"), F.lit("Y").alias("is_main")).distinct()
    ids, n = ["store", "receipt_no", "sold_at"], 1
    if isinstance(hot, str) and hot == AUTO:  # lines are counted by receipt before the headers name the orders
        per_receipt = items.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n"))
        named = heads.select(*ids, "order_id").join(per_receipt, ids).groupBy("order_id")
        hot, counted = hot_and_rows(named.agg(F.sum("_n").alias("_n")))
        n = slice_count(heads.sparkSession, counted, 3)
    # Receipts of one order id must share a slice. What stands before the first _ of their number is in the id too, if no
    # POS has a _ in its own; else what stands after the last _ of the id, which ends in the time of sale.
    shared = F.substring_index("_no", "_", 1)
    if n > 1 and not heads.where(F.col("pos_no").contains("_")).isEmpty():
        shared = F.substring_index(F.concat_ws("_", "receipt_no", "sold_at"), "_", -1)

    def lines(heads, items):
        rows = heads_with_lines(heads, items.join(main, "item_id", "left"), ids, hot=hot)
        rows = rows.drop("receipt_no", "sold_at", "pos_no", "item_sale_type", "category").withColumns(
            {
                "unit_price": F.coalesce("unit_price", F.lit(0)), "item_id": F.coalesce("item_id", F.lit("")),
                "qty": F.coalesce("qty", F.lit(0)), "item_name": F.coalesce("item_name", F.lit("")), "pack": F.coalesce("pack", F.lit(False)),
            }
        )
        rows = _union_lines(rows, ["order_id"], line_order, hot=hot)
        rows = rows.withColumns(
            {
                "platform": F.lit(HALL), "order_type": F.when(F.col("_pack"), HALL_PACK).otherwise(HALL_TABLE),
                "total_price": signed_amount("unit_price", is_cancelled()), "discount_amount": F.lit(0),
                "menu_name": F.coalesce("menu_name", F.lit("")),
            }
        )
        blank = F.col("item_name") == ""
        rows = rows.where(~(blank & (F.col("unit_price") == 0)) & ~(blank & (F.col("item_id") == "")))
        return rows.select(*[x for x in UNIFIED if x in rows.columns])

    parts = (lines(*x) for x in slices([heads, items], shared, n, ["_no"]))
    return _finish_slices(parts, n, stores, source, brand)


# -- single-store POS ---------------------------------------------------------


def unify_easy_pos(
    raw: DataFrame, stores: DataFrame, master: DataFrame, line_order: Sequence[str], store: str, source: str = "easy",
    brand: str = "", hot=AUTO,
) -> DataFrame:
    """One store's receipts; ids come from the product name; one line per receipt counts the order."""
    rows = c.coalesce_dup_columns(raw)
    time = c.normalize_time("order_time")
    order_id = F.concat_ws("_", "receipt_no", F.date_format("sale_date", "yyyy-MM-dd"), time)
    hot = resolve_hot(raw.select(order_id.alias("order_id")), ["order_id"], hot)
    rows = rows.withColumns(
        {
            "store": F.lit(store), "order_time": time,
            "order_type": F.when(F.col("receipt_type").contains(PACK), HALL_PACK).otherwise(HALL_TABLE), "platform": F.lit(HALL),
            "unit_price": c.money_to_int("line_amount"), "qty": F.coalesce("qty", F.lit(0)),
            "sale_type": F.when(F.trim("sale_type") == "반품", CANCELLED).otherwise(NORMAL),
            "order_id": order_id,
            "item_name": c.text("item_name"), "item_id": F.lit(""), "discount_amount": F.lit(0),
        }
    )
    rows = rows.withColumn("total_price", signed_amount("unit_price", is_cancelled()))
    rows = code_to_name_map(rows, master.select("code", "name"), "item_id", "item_name")
    return finish(_easy_orders(rows, ["order_id"], line_order, hot=hot), stores, source, brand, one_store=store)


@by_heat
def _easy_orders(rows: DataFrame, keys, line_order, hot=AUTO):
    return o.representative_row(o.item_seq(rows, keys, line_order, hot=hot), keys, "unit_price", hot=hot)


# -- delivery platforms -------------------------------------------------------


@by_heat
def _platform_a_orders(rows: DataFrame, keys, line_order, hot=AUTO):
    rows = o.item_seq(rows, keys, line_order, hot=hot)
    match = F.col("item_name") == F.col("menu_name")
    values = {**o.spread_values("paid"), **o.share_values("item_total"), **o.representative_values("unit_price", match)}
    rows = attach(rows, keys, values, hot=hot)
    rows = o.first_nonzero_spread(rows, keys, "paid", "order_paid", attached=True, hot=hot)
    rows = o.proportional_allocation(rows, keys, "item_total", "order_paid", "total_price", attached=True, hot=hot)
    return o.representative_row(rows, keys, "unit_price", 0, match, set_menu=False, attached=True, hot=hot)


def unify_platform_a(
    raw: DataFrame, stores: DataFrame, line_order: Sequence[str], delivered: str, source: str = "platform_a",
    platform: str = "A", hot=AUTO,
) -> DataFrame:
    """Delivered orders; the paid amount stands on one line and is split by line value."""
    hot = resolve_hot(raw.select("order_id"), ["order_id"], hot)
    day, clock = c.parse_localized_datetime("ordered_at")
    name = c.text("option_name")
    rows = raw.where(c.text("status") == delivered).withColumns(
        {
            "sale_date": day, "order_time": clock, "platform": F.lit(platform), "sale_type": F.lit(NORMAL),
            "order_type": F.when(c.text("receive") == PACK, DELIVERY_PACK).otherwise(DELIVERY),
            "menu_name": c.strip_count_suffix("summary"), "item_name": name,
            "qty": F.when(c.money_to_int("qty") == 0, 1).otherwise(c.money_to_int("qty")),
            "unit_price": c.money_to_int("option_price"), "paid": c.money_to_int("paid"), "discount_amount": F.lit(0),
            "item_id": F.when(name != "", F.md5(name)).otherwise(""),
        }
    )
    rows = rows.withColumn("item_total", F.col("unit_price") * F.col("qty"))
    return finish(_platform_a_orders(rows, ["order_id"], line_order, hot=hot), stores, source, F.col("brand"))


@by_heat
def _platform_b_orders(rows: DataFrame, keys, line_order, hot=AUTO):
    rows = o.item_seq(rows, keys, line_order, hot=hot)
    first_sale = F.min_by("sales", F.when(F.col("sales") > 0, F.col("item_seq")))
    rows = attach(
        rows, keys,
        {"_first": first_sale, "_most": F.max(F.when(F.col("total") > 0, F.col("total"))), "_off": F.max(F.upper(c.text("cancelled")) == "Y")},
        hot=hot,
    )
    rows = rows.withColumn("order_amount", F.coalesce("_first", "_most", F.lit(0))).where(~F.col("_off") & (F.col("order_amount") > 0))
    rows = o.menu_group_segments(rows, keys, "menu_price", hot=hot)
    rows = o.remainder_allocation(
        rows, keys, "menu_group", "menu_price", "menu_qty", "option_price", "order_amount", "total_price", hot=hot
    )
    rows = rows.withColumn("unit_price", F.col("total_price"))
    match = F.col("item_name") == F.col("menu_name")
    return o.representative_row(rows, keys, "unit_price", 0, match, set_menu=False, hot=hot)


def unify_platform_b(
    raw: DataFrame, stores: DataFrame, option_prices: DataFrame, line_order: Sequence[str], dedup: dict[str, bool],
    source: str = "platform_b", platform: str = "B", hot=AUTO,
) -> DataFrame:
    """Orders without cancelled lines; the order amount is split exactly over menu groups and paid options."""
    hot, n = _hot_and_slices(raw, ["order_id"], hot, 2)
    prices = stage(keep_one(option_prices, ["item_name"], ["option_price"]))  # of known size, so a short list is broadcast
    raw = raw.withColumn("_order", c.text("order_id"))
    day, clock = c.parse_localized_datetime("ordered_at")
    name = c.text("menu_options")

    def lines(raw):
        keys, within = ["order_id"], []
        if hot is None and "order_id" in dedup:  # one shuffle by order serves the copies of a line and all steps in its order
            keys, within = ["_order", "order_id"], ["_order"]
            raw = raw.repartition("_order")
        raw = o.canonical_line_dedup(raw, dedup, [F.col("collected_at").desc_nulls_last(), *line_order], within)
        rows = raw.withColumns(
            {
                "sale_date": day, "order_time": clock, "platform": F.lit(platform), "sale_type": F.lit(NORMAL),
                "order_type": F.when(c.text("delivery_type") == PACK, DELIVERY_PACK).otherwise(DELIVERY),
                "menu_name": c.text("menu_name"), "item_name": name, "item_id": F.when(name != "", F.md5(name)).otherwise(""),
                "qty": F.when(F.coalesce("menu_qty", F.lit(0)) == 0, 1).otherwise(F.col("menu_qty")), "discount_amount": F.lit(0),
            }
        )
        rows = rows.join(prices, "item_name", "left").fillna(0, ["option_price"])
        rows = _platform_b_orders(rows, keys, line_order, hot=hot)
        return rows.select(*[x for x in UNIFIED if x in rows.columns])

    n = n if "order_id" in dedup else 1  # else copies of a line may lie in several orders
    parts = (lines(*x) for x in slices([raw], "_order", n))
    return _finish_slices(parts, n, stores, source, F.col("brand"))


# -- totals, extracts, sheets -------------------------------------------------


def unify_report_totals(
    totals: DataFrame, covered: DataFrame, stores: DataFrame, platforms: dict[str, str], order_types: dict[str, str],
    source: str = "report",
) -> DataFrame:
    """Platform totals per day as one-line orders, for stores no better source covers."""
    rows = totals.where(F.col("price") > 0)
    rows = exclude_overlapping_stores(rows, covered).withColumn("platform", mapped("platform", platforms))
    g = rows.groupBy("sale_date", "brand", "store", "platform").agg(F.sum("price").alias("total_price"))
    known = F.create_map(*[F.lit(x) for kv in order_types.items() for x in kv])
    named = lambda x: F.when(c.text(x) != "", c.text(x)).otherwise("unknown")
    g = g.withColumns(
        {
            "order_id": F.concat_ws("_", named("store"), named("platform")), "order_time": F.lit("00:00:00"),
            "order_type": F.coalesce(F.element_at(known, F.col("platform")), F.lit(DELIVERY)),
            "item_seq": F.lit(1), "qty": F.lit(1), "unit_price": F.col("total_price"), "discount_amount": F.lit(0),
            "sale_type": F.lit(NORMAL), "order_cnt": F.lit(1),
            "menu_name": F.lit(""), "item_id": F.lit(""), "item_name": F.lit(""),
        }
    )
    return finish(g, stores, source, F.col("brand"))


def dates_to_build(available: DataFrame, existing: DataFrame, as_of, lookback: int, day: str = "sale_date") -> DataFrame:
    """Days of the look-back window, and earlier days the fact does not have yet."""
    days = available.select(day).distinct()
    fresh = days.where(F.col(day) > F.date_sub(F.lit(as_of).cast("date"), lookback))
    absent = days.where(F.col(day) <= F.date_sub(F.lit(as_of).cast("date"), lookback)).join(
        existing.select(day).distinct(), day, "left_anti"
    )
    return fresh.unionByName(absent)


def platform_orders_extract(exports: Sequence[DataFrame], stores: DataFrame, line_order: Sequence[str], hot=AUTO) -> DataFrame:
    """Exports of several platforms in the common order-line shape.

    Each has platform, order_id, ordered_at, store_name, summary, option_name, amount, coupon and the line order columns.
    """
    rows = exports[0]
    for e in exports[1:]:
        rows = rows.unionByName(e, allowMissingColumns=True)
    hot = resolve_hot(rows.select("order_id"), ["order_id"], hot)
    day, clock = c.parse_localized_datetime("ordered_at")
    rows = rows.withColumns({"order_daily": day, "order_time": clock, "option": c.pure_option("summary", "option_name")})
    look = keep_one(stores.withColumn("_k", last_two_tokens("store_name")), ["_k"], ["store_name"]).select("_k", "manager")
    rows = rows.withColumn("_k", last_two_tokens("store_name")).join(look, "_k", "left").drop("_k")
    rows = _coupon_lines(rows, ["order_id"], hot=hot)
    return sub_order_id(rows, "order_id", line_order, hot=hot)


@by_heat
def _coupon_lines(rows: DataFrame, keys, hot=AUTO):
    rows = attach(rows, keys, {"_c": F.sum(F.coalesce("coupon", F.lit(0)))}, hot=hot)
    return rows.withColumn("coupon_yn", F.when(F.col("_c") > 0, "Y").otherwise("N")).drop("_c")


def report_sheet_to_long(sheets: DataFrame, blocks: Sequence[tuple[str, str, str]], total_label: str = "합계") -> DataFrame:
    """Per-day sheets (a row per channel, two columns per store) to (day, store, platform, price, receipts)."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(st).alias("store"), F.col(p).alias("price"), F.col(n).alias("receipts")) for st, p, n in blocks])
    )
    long = sheets.where(F.trim("channel") != total_label).select("sale_date", F.trim("channel").alias("platform"), cells.alias("cell"))
    out = long.select("sale_date", "cell.store", "platform", c.money_to_int("cell.price").alias("price"), c.money_to_int("cell.receipts").alias("receipts"))
    return out.where((F.col("price") != 0) | (F.col("receipts") != 0))
