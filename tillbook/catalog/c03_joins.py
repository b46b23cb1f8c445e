"""Joins."""

from pyspark.sql import functions as F

from tillbook.catalog.base import (
    EVENTS, HEADS, LINES, PRODUCTS, RAW_LINES, REVIEWS, SERIES, STORES, big, query, ratio, rnd, tint,
)
from tillbook.catalog.c02_series import QUOTES, quotes
from tillbook.operators import joins as j
from tillbook.operators.core import keep_one
from tillbook.plans import marts
from tillbook.session import fresh_path, stage
from tillbook.sources.fixtures import AS_OF
from tillbook.sources.snapshots import Snapshot

D = "CAST(sale_date AS VARCHAR) AS sale_date"
Y = "strftime"


@query("order_item_join", f"""WITH {HEADS}, {RAW_LINES} SELECT h.order_id, CAST(h.sale_date AS VARCHAR) AS sale_date, h.store,
  h.order_amount, l.l_linenumber, l.l_partkey, l.qty, l.net_amount, CASE WHEN l.l_orderkey IS NULL THEN 1 ELSE 0 END AS no_items
  FROM heads h LEFT JOIN raw_lines l ON l.l_orderkey = h.o_orderkey""")
def order_item_join(t):
    h, l = t.heads, t.raw_lines
    return j.order_item_join(h, l, {"o_orderkey": "l_orderkey"}).select(
        "order_id", "sale_date", "store", "order_amount", "l_linenumber", "l_partkey", "qty", "net_amount",
        F.col("l_orderkey").isNull().cast("int").alias("no_items"),
    )


@query("dim_enrich", f"""WITH {HEADS} SELECT order_id, region || ' ' || store AS store_name, region, manager,
  CAST(open_date AS VARCHAR) AS open_date FROM heads""")
def dim_enrich(t):
    facts = t.heads.select("order_id", F.concat_ws(" ", "region", "store").alias("store_name"))
    return j.dim_enrich(facts, t.stores, "store_name", "store", ["region", "manager", "open_date"])


NAME = """CASE platform WHEN 'BUILDING' THEN 'BRAND ' || replace(region, ' ', '_') || ' ' || store
  WHEN 'AUTOMOBILE' THEN replace(region, ' ', '_') || ' ' || store
  WHEN 'HOUSEHOLD' THEN 'UNKNOWN PLACE' ELSE store END"""


@query("cascading_match", f"""WITH {HEADS}, f AS (SELECT order_id, {NAME} AS store_name FROM heads),
  dims AS (SELECT 'BRAND ' || replace(region, ' ', '_') || ' ' || store AS full_name, replace(region, ' ', '_') || ' ' || store AS two,
    store AS one, manager FROM stores)
  SELECT order_id, store_name, CASE WHEN d1.manager IS NOT NULL THEN 1 WHEN d2.manager IS NOT NULL THEN 2
    WHEN d3.manager IS NOT NULL THEN 3 END AS match_stage, COALESCE(d1.manager, d2.manager, d3.manager) AS manager
  FROM f LEFT JOIN dims d1 ON d1.full_name = store_name LEFT JOIN dims d2 ON d2.two = store_name
  LEFT JOIN dims d3 ON d3.one = store_name""")
def cascading_match(t):
    us = F.regexp_replace("region", " ", "_")
    full = F.concat_ws(" ", F.lit("BRAND"), us, "store")
    name = (
        F.when(F.col("platform") == "BUILDING", full)
        .when(F.col("platform") == "AUTOMOBILE", F.concat_ws(" ", us, "store"))
        .when(F.col("platform") == "HOUSEHOLD", "UNKNOWN PLACE")
        .otherwise(F.col("store"))
    )
    facts = t.heads.select("order_id", name.alias("store_name"))
    dim = t.stores.select(full.alias("full_name"), "manager")
    return j.cascading_match(facts, dim, "store_name", "full_name", ["manager"])


@query("manager_refresh_join", f"""WITH {HEADS} SELECT order_id, store, CASE WHEN source = 'F' THEN 'OLD' END AS old_manager,
  COALESCE(CASE WHEN s.store_key % 3 > 0 THEN s.manager END, CASE WHEN source = 'F' THEN 'OLD' END, '미배정') AS manager
  FROM heads JOIN stores s USING (store)""")
def manager_refresh_join(t):
    old = F.when(F.col("source") == "F", "OLD")
    facts = t.heads.select("order_id", "store", old.alias("old_manager"), old.alias("manager"))
    # Stores the new list leaves blank keep the stored manager.
    fresh = t.stores.select("store", F.when(F.col("store_key") % 3 > 0, F.col("manager")).alias("manager"))
    return j.manager_refresh_join(facts, fresh, "store", "manager")


@query("multi_source_daily_join", f"""WITH {EVENTS}, {REVIEWS},
  base AS (SELECT d, store, count(*) FILTER (event_type = 'purchase') AS orders,
    {big("COALESCE(sum(amount) FILTER (event_type = 'purchase'), 0)")} AS sales FROM ev GROUP BY d, store),
  rv AS (SELECT d, store, count(*) AS reviews, count(*) FILTER (sentiment = 'negative') AS negatives FROM rev GROUP BY d, store),
  ch AS (SELECT d, store, event_id AS last_change, event_type AS change_type FROM ev WHERE event_type <> 'purchase'
    QUALIFY row_number() OVER (PARTITION BY d, store ORDER BY ts DESC, event_id DESC) = 1)
  SELECT CAST(b.d AS VARCHAR) AS d, b.store, orders, sales, reviews, negatives, last_change, change_type
  FROM base b LEFT JOIN rv USING (d, store) LEFT JOIN ch USING (d, store)""")
def multi_source_daily_join(t):
    buy = F.col("event_type") == "purchase"
    base = t.events.groupBy("d", "store").agg(
        F.count(F.when(buy, 1)).alias("orders"),
        F.coalesce(F.sum(F.when(buy, F.col("amount"))), F.lit(0)).alias("sales"),
    )
    rv = t.reviews.groupBy("d", "store").agg(
        F.count(F.lit(1)).alias("reviews"), F.count(F.when(F.col("sentiment") == "negative", 1)).alias("negatives")
    )
    ch = t.events.where(~buy).select(
        "d", "store", F.col("event_id").alias("last_change"), F.col("event_type").alias("change_type"), F.col("ts").alias("_ts")
    )
    return j.multi_source_daily_join(
        base, ["d", "store"], [(rv, ["reviews"]), (ch, [F.col("_ts").desc(), F.col("last_change").desc()])]
    ).drop("_ts")


RECON = f"""a AS (SELECT sale_date, store, {big('sum(order_amount)')} AS reported FROM heads WHERE source <> 'P' GROUP BY ALL),
  b AS (SELECT sale_date, store, {big('sum(net_amount)')} AS unified FROM lines GROUP BY ALL),
  j AS (SELECT sale_date, store, COALESCE(reported, 0) AS reported, COALESCE(unified, 0) AS unified FROM a FULL JOIN b USING (sale_date, store)),
  e AS (SELECT *, unified - reported AS difference, COALESCE({rnd(ratio('abs(unified - reported)', 'abs(reported)') + ' * 100')}, 0.0) AS error_rate FROM j)"""


@query("full_outer_reconcile", f"""WITH {LINES}, {RECON} SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date),
  CASE WHEN error_rate >= 2 THEN 'error' ELSE 'ok' END AS status FROM e""")
def full_outer_reconcile(t):
    a = t.heads.where(F.col("source") != "P").groupBy("sale_date", "store").agg(F.sum("order_amount").alias("reported"))
    b = t.lines.groupBy("sale_date", "store").agg(F.sum("net_amount").alias("unified"))
    return j.full_outer_reconcile(a, b, ["sale_date", "store"], "reported", "unified")


GRID = STORES + f""", st AS (SELECT *, CASE WHEN store_key % 5 = 0 THEN CAST(open_date + 1500 AS DATE) END AS close_date FROM stores),
  grid AS (SELECT strftime(m, '%Y-%m') AS ym, store, open_date, close_date,
    CASE WHEN open_date <= last_day(m) AND (close_date IS NULL OR close_date >= m) THEN 1 ELSE 0 END AS is_active,
    CASE WHEN open_date BETWEEN m AND last_day(m) THEN 1 ELSE 0 END AS is_new,
    CASE WHEN close_date BETWEEN m AND last_day(m) THEN 1 ELSE 0 END AS is_closed
  FROM st, (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '{AS_OF}', INTERVAL 1 MONTH)) AS DATE) AS m))"""


def grid(t):
    st = t.stores.withColumn("close_date", F.when(F.col("store_key") % 5 == 0, F.date_add("open_date", 1500)))
    return j.calendar_grid(st, "1995-01-01", AS_OF)


@query("cross_join_calendar", f"""WITH {GRID} SELECT * REPLACE (CAST(open_date AS VARCHAR) AS open_date,
  CAST(close_date AS VARCHAR) AS close_date) FROM grid""")
def cross_join_calendar(t):
    return grid(t)


@query("closing_rate_kpi", f"""WITH {GRID}, k AS (SELECT ym, {big('sum(is_active)')} AS active_count, {big('sum(is_new)')} AS new_open,
  {big('sum(is_closed)')} AS closed FROM grid GROUP BY ym)
  SELECT *, COALESCE({rnd(ratio('closed', 'active_count'), 4)}, 0.0) AS closing_rate FROM k""")
def closing_rate_kpi(t):
    return marts.closing_rate_kpi(grid(t))


@query("range_join_launch", f"""WITH {LINES}, launch AS (SELECT CAST(p.p_partkey AS VARCHAR) AS item_id, p.p_name AS item_name,
    CAST(DATE '1997-01-01' + CAST(p.p_size AS INTEGER) * 30 AS DATE) AS launch_date FROM part p)
  SELECT a.item_id, a.item_name, CAST(a.launch_date AS VARCHAR) AS launch_date, {big('COALESCE(sum(l.qty), 0)')} AS qty_30d,
    {big('COALESCE(sum(l.total_price), 0)')} AS revenue_30d
  FROM launch a LEFT JOIN lines l ON l.item_id = a.item_id AND l.sale_date BETWEEN a.launch_date AND a.launch_date + INTERVAL 30 DAY
  GROUP BY a.item_id, a.item_name, a.launch_date""")
def range_join_launch(t):
    launch = t.products.select(
        F.col("code").alias("item_id"), F.col("name").alias("item_name"),
        F.date_add(F.lit("1997-01-01").cast("date"), F.col("size") * 30).alias("launch_date"),
    )
    return j.range_join_launch(t.lines, launch)


def near_sql(target, tol, out):
    return f"""(SELECT site, base_date, price AS {out} FROM (SELECT a.site, a.base_date, b.price, row_number() OVER (
      PARTITION BY a.site, a.base_date ORDER BY abs(date_diff('day', CAST({target} AS DATE), b.base_date)), b.base_date) AS n
      FROM quotes a JOIN quotes b ON a.site = b.site
        AND b.base_date BETWEEN CAST({target} AS DATE) - INTERVAL {tol} DAY AND CAST({target} AS DATE) + INTERVAL {tol} DAY) WHERE n = 1)"""


@query("nearest_asof", f"""WITH {QUOTES} SELECT q.site, CAST(q.base_date AS VARCHAR) AS base_date, q.price, m.price_prev_month,
  y.price_prev_year FROM quotes q
  LEFT JOIN {near_sql('a.base_date - INTERVAL 1 MONTH', 7, 'price_prev_month')} m USING (site, base_date)
  LEFT JOIN {near_sql('a.base_date - INTERVAL 1 YEAR', 14, 'price_prev_year')} y USING (site, base_date)""")
def nearest_asof(t):
    q = stage(quotes(t).drop("collected_at"))
    out = j.nearest_asof(q, q, "site", F.add_months("base_date", -1), 7, "price_prev_month")
    return j.nearest_asof(out, q, "site", F.add_months("base_date", -12), 14, "price_prev_year")


ACTIONS = SERIES + """, acts AS (SELECT DISTINCT store, CAST(date_trunc('month', sale_date) + INTERVAL 14 DAY AS DATE) AS action_date FROM series)"""


def actions(series):
    mid = F.date_add(F.trunc("sale_date", "MM"), 14).alias("action_date")
    return series.select("store", mid).distinct()


def side(op, order, n=7):
    return f"""(SELECT store, action_date, {big('sum(total_amount)')} AS total_amount, avg(settlement_amount) AS settlement_amount FROM (
      SELECT a.store, a.action_date, s.total_amount, s.settlement_amount, row_number() OVER (
        PARTITION BY a.store, a.action_date ORDER BY s.sale_date {order}) AS n
      FROM acts a JOIN series s ON s.store = a.store AND s.sale_date {op} a.action_date) WHERE n <= {n} GROUP BY ALL)"""


EVENT_WINDOW = ACTIONS + f""", ew AS (SELECT a.store, a.action_date, p.total_amount AS total_amount_prev, q.total_amount AS total_amount_next,
  {rnd('p.settlement_amount', 4)} AS settlement_amount_prev, {rnd('q.settlement_amount', 4)} AS settlement_amount_next,
  s.total_amount AS total_amount_spot, s.settlement_amount AS settlement_amount_spot
  FROM acts a LEFT JOIN {side('<', 'DESC')} p USING (store, action_date) LEFT JOIN {side('>', 'ASC')} q USING (store, action_date)
  LEFT JOIN series s ON s.store = a.store AND s.sale_date = a.action_date)"""


def event_window(t):
    from tillbook.functions.numbers import rnd as r

    series = stage(t.series)
    out = j.event_window_join(actions(series), series, "store", {"total_amount": "sum", "settlement_amount": "mean"})
    return out.withColumns({c: r(c, 4) for c in ("settlement_amount_prev", "settlement_amount_next")})


@query("event_window_join", f"WITH {EVENT_WINDOW} SELECT * REPLACE (CAST(action_date AS VARCHAR) AS action_date) FROM ew")
def event_window_join(t):
    return event_window(t)


@query("action_effect", f"""WITH {EVENT_WINDOW} SELECT store, CAST(action_date AS VARCHAR) AS action_date, total_amount_prev, total_amount_next,
  total_amount_next - total_amount_prev AS total_amount_delta,
  {rnd(ratio('(total_amount_next - total_amount_prev)', 'abs(total_amount_prev)') + ' * 100', 1)} AS total_amount_change_pct,
  CASE WHEN total_amount_next >= total_amount_prev THEN '개선' WHEN total_amount_next < total_amount_prev THEN '악화' END AS total_amount_result,
  CASE WHEN settlement_amount_next <= settlement_amount_prev THEN '개선' WHEN settlement_amount_next > settlement_amount_prev THEN '악화' END AS settlement_amount_result
  FROM ew""")
def action_effect(t):
    from tillbook.plans.effects import action_effect as effect

    out = effect(event_window(t), {"total_amount": True, "settlement_amount": False})
    return out.select(
        "store", "action_date", "total_amount_prev", "total_amount_next", "total_amount_delta",
        "total_amount_change_pct", "total_amount_result", "settlement_amount_result",
    )


@query("anti_new_keys", f"""WITH {HEADS} SELECT order_id, store FROM heads WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def anti_new_keys(t):
    known = t.table("lineitem").select(F.col("l_orderkey").cast("string").alias("order_id")).distinct()
    return j.anti_new_keys(t.heads.select("order_id", "store"), known, ["order_id"])


@query("snapshot_change_detect", f"""WITH {PRODUCTS}, old AS (SELECT code, name, list_price FROM products WHERE label <> 'PROMO'),
  new AS (SELECT code, name, CASE WHEN brand = 'Brand#7' THEN list_price + 100 ELSE list_price END AS list_price FROM products)
  SELECT n.code, n.name, n.list_price, CASE WHEN o.code IS NULL THEN '신규' ELSE '변경' END AS change_type
  FROM new n LEFT JOIN old o USING (code) WHERE o.code IS NULL OR o.name <> n.name OR o.list_price <> n.list_price""")
def snapshot_change_detect(t):
    p = t.products
    old = p.where(F.col("label") != "PROMO").select("code", "name", "list_price")
    price = F.when(F.col("brand") == "Brand#7", F.col("list_price") + 100).otherwise(F.col("list_price"))
    new = p.select("code", "name", price.alias("list_price"))
    return j.snapshot_change_detect(new, old, ["code"], ["name", "list_price"])


@query("snapshot_bucket_changes", f"""WITH {PRODUCTS}, old AS (SELECT code, name, list_price FROM products WHERE part_key % 997 <> 5),
  new AS (SELECT code, name, CASE WHEN part_key % 499 = 7 THEN list_price + 100 ELSE list_price END AS list_price FROM products)
  SELECT n.code, n.name, n.list_price, CASE WHEN o.code IS NULL THEN '신규' ELSE '변경' END AS change_type, true AS few_buckets
  FROM new n LEFT JOIN old o USING (code) WHERE o.code IS NULL OR o.name <> n.name OR o.list_price <> n.list_price""")
def snapshot_bucket_changes(t):
    """Few products changed: their buckets are found by checksums, and only those are read."""
    cols = ["code", "name", "list_price"]
    old = t.products.where(F.col("part_key") % 997 != 5).select(*cols)
    price = F.when(F.col("part_key") % 499 == 7, F.col("list_price") + 100).otherwise(F.col("list_price"))
    new = t.products.select("code", "name", price.alias("list_price"))
    snapshot = Snapshot(t.spark, fresh_path(t.spark, "snapshot"), old.schema, ["code"], ["name", "list_price"], buckets=64)
    snapshot.update(old)
    few = len(snapshot.differing(snapshot._dealt(new))) < 48
    return snapshot.changes(new).withColumn("few_buckets", F.lit(few))


@query("code_to_name_map", f"""WITH {PRODUCTS}, {RAW_LINES}, m AS (SELECT * FROM products WHERE label <> 'PROMO'),
  nm AS (SELECT name, min(code) AS code FROM m GROUP BY name),
  l AS (SELECT l_orderkey, l_linenumber, l.l_partkey, p.p_name AS item_name,
    CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(l.l_partkey AS VARCHAR) END AS item_id
    FROM raw_lines l JOIN part p ON p.p_partkey = l.l_partkey),
  c AS (SELECT l.*, COALESCE(NULLIF(l.item_id, ''), nm.code, md5(l.item_name)) AS code2 FROM l LEFT JOIN nm ON nm.name = l.item_name)
  SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.code2 AS item_id, COALESCE(m.name, c.item_name) AS item_name
  FROM c LEFT JOIN m ON m.code = c.code2""")
def code_to_name_map(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item_name"))
    code = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_partkey").cast("string"))
    lines = t.raw_lines.withColumn("item_id", code).join(p, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "item_name", "item_id"
    )
    return j.code_to_name_map(lines, t.products.where(F.col("label") != "PROMO"), "item_id", "item_name")


@query("missing_key_grid", f"""WITH {HEADS}, g AS (SELECT s.store, CAST(d AS DATE) AS sale_date
    FROM stores s, generate_series(DATE '1995-01-01', DATE '{AS_OF}', INTERVAL 1 DAY) x(d) WHERE CAST(d AS DATE) >= s.open_date),
  nodata AS (SELECT DISTINCT store, sale_date + INTERVAL 1 DAY AS sale_date FROM heads WHERE source = 'P')
  SELECT store, {D} FROM g WHERE NOT EXISTS (SELECT 1 FROM heads h WHERE h.store = g.store AND h.sale_date = g.sale_date)
  AND NOT EXISTS (SELECT 1 FROM nodata n WHERE n.store = g.store AND n.sale_date = g.sale_date)""")
def missing_key_grid(t):
    nodata = t.heads.where(F.col("source") == "P").select("store", F.date_add("sale_date", 1).alias("sale_date"))
    return j.missing_key_grid(t.stores, "1995-01-01", AS_OF, t.heads, nodata)


REF = HEADS + f""", o AS (SELECT order_id, store, CAST(date_trunc('month', sale_date) AS DATE) AS m, o_orderkey % 100 AS pos, o_orderkey,
    CASE WHEN source <> 'P' THEN 'MENU ' || (o_orderkey % 13) END AS menu_name, CAST(trunc(order_amount / 5000) AS BIGINT) AS abs_total FROM heads)"""


@query("refund_inherit", f"""WITH {REF}, a AS (SELECT store, m, abs_total, menu_name AS x FROM o WHERE menu_name IS NOT NULL AND abs_total > 0
    QUALIFY row_number() OVER (PARTITION BY store, m, abs_total ORDER BY o_orderkey) = 1),
  r AS (SELECT store, pos, menu_name AS y FROM o WHERE menu_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store, pos ORDER BY o_orderkey) = 1)
  SELECT o.order_id, o.store, o.abs_total, COALESCE(o.menu_name, a.x, r.y) AS menu_name FROM o
  LEFT JOIN a USING (store, m, abs_total) LEFT JOIN r ON r.store = o.store AND r.pos = o.pos""")
def refund_inherit(t):
    orders = t.heads.select(
        "order_id", "store", F.trunc("sale_date", "MM").alias("m"), (F.col("o_orderkey") % 100).alias("pos"),
        F.col("o_orderkey").alias("order_seq"),
        F.when(F.col("source") != "P", F.concat(F.lit("MENU "), F.col("o_orderkey") % 13)).alias("menu_name"),
        (F.col("order_amount") / 5000).cast("bigint").alias("abs_total"),
    )
    return j.refund_inherit(orders, ["store", "m"], ["store", "pos"]).select("order_id", "store", "abs_total", "menu_name")


SLOTS = HEADS + f""", s0 AS (SELECT *, o_orderkey % 10 AS pos, CAST(substr(order_time, 1, 2) AS INTEGER) AS h FROM heads),
  s1 AS (SELECT *, CASE WHEN h >= 6 AND h < 16 THEN '점심' WHEN h >= 16 THEN '저녁' END AS slot FROM s0),
  lk AS (SELECT sale_date, pos, min(slot) AS matched FROM s1 WHERE slot IS NOT NULL GROUP BY ALL),
  dd AS (SELECT sale_date, slot AS dflt FROM (SELECT sale_date, slot, sum(abs(order_amount)) AS amt FROM s1 WHERE slot IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY sale_date ORDER BY amt DESC, slot DESC) = 1),
  slots AS (SELECT s1.*, COALESCE(slot, matched, dflt, '저녁') AS time_slot FROM s1 LEFT JOIN lk USING (sale_date, pos) LEFT JOIN dd USING (sale_date))"""


def slotted(t):
    rows = t.heads.withColumn("pos", F.col("o_orderkey") % 10)
    return j.time_slot_inherit(rows, ["pos"], F.substring("order_time", 1, 2).cast("int"), "order_amount")


@query("time_slot_inherit", f"WITH {SLOTS} SELECT order_id, {D}, pos, time_slot FROM slots")
def time_slot_inherit(t):
    return slotted(t).select("order_id", "sale_date", "pos", "time_slot")


MASTER = """mst AS (SELECT CAST(p_partkey AS VARCHAR) AS code, CASE WHEN p_type IN ('LARGE', 'ECONOMY') THEN 'Y' ELSE 'N' END AS is_main_candidate,
  CASE WHEN p_brand = 'Brand#3' THEN 'Y' ELSE 'N' END AS exclude_check FROM part WHERE p_size > 10)"""


def master(t):
    return t.products.where(F.col("size") > 10).select(
        "code", F.when(F.col("label").isin("LARGE", "ECONOMY"), "Y").otherwise("N").alias("is_main_candidate"),
        F.when(F.col("brand") == "Brand#3", "Y").otherwise("N").alias("exclude_check"),
    )


@query("unmatched_reason", f"""WITH {MASTER}, c AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS code FROM lineitem),
  r AS (SELECT c.code, CASE WHEN m.code IS NULL THEN 'not_registered' WHEN exclude_check = 'Y' THEN 'excluded'
    WHEN is_main_candidate <> 'Y' THEN 'not_main_candidate' END AS reason FROM c LEFT JOIN mst m USING (code))
  SELECT * FROM r WHERE reason IS NOT NULL""")
def unmatched_reason(t):
    codes = t.table("lineitem").select(F.col("l_partkey").cast("string").alias("code"))
    return j.unmatched_reason(codes, master(t))


@query("new_item_draft", f"""WITH ctl AS (SELECT DISTINCT p_name AS item_name, 'N' AS is_valid, '' AS store, '' AS review_needed, 'manual' AS classified_by
    FROM part WHERE p_type = 'PROMO'), it AS (SELECT DISTINCT p.p_brand || ' ' || p.p_name AS item_name FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
    UNION SELECT p_name FROM part)
  SELECT * FROM ctl UNION ALL SELECT item_name, CASE WHEN contains(item_name, 'ring') THEN 'N' ELSE 'Y' END, '', 'Y', 'auto_rule' FROM it
  WHERE item_name NOT IN (SELECT item_name FROM ctl)""")
def new_item_draft(t):
    p = t.table("part")
    control = p.where(F.col("p_type") == "PROMO").select(
        F.col("p_name").alias("item_name"), F.lit("N").alias("is_valid"), F.lit("").alias("store"),
        F.lit("").alias("review_needed"), F.lit("manual").alias("classified_by"),
    ).distinct()
    sold = t.table("lineitem").select("l_partkey").distinct().join(p, F.col("l_partkey") == F.col("p_partkey"))
    items = sold.select(F.concat_ws(" ", "p_brand", "p_name").alias("item_name")).union(p.select("p_name"))
    return j.new_item_draft(items, control, F.when(F.col("item_name").contains("ring"), "N").otherwise("Y"))
