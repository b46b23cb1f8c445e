"""Aggregate marts."""

from pyspark.sql import functions as F

from tillbook.catalog.base import (
    EVENTS, HEADS, LINES, PRODUCTS, REVIEWS, SERIES, big, pct, query, ratio, rint, rnd, tint,
)
from tillbook.catalog.c02_series import manager_lines, over, roll
from tillbook.catalog.c03_joins import SLOTS, slotted
from tillbook.functions.rules import review_reasons
from tillbook.plans import marts as m
from tillbook.sources.fixtures import AS_OF

D = "CAST(sale_date AS VARCHAR) AS sale_date"
PLATFORMS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
HALL = """CASE order_type WHEN '1-URGENT' THEN '홀_테이블' WHEN '2-HIGH' THEN '홀_포장' WHEN '3-MEDIUM' THEN '홀_카운터'
  WHEN '4-NOT SPECIFIED' THEN '배달' ELSE '배달_포장' END"""


def hall_type():
    ot = F.col("order_type")
    return (
        F.when(ot == "1-URGENT", "홀_테이블").when(ot == "2-HIGH", "홀_포장").when(ot == "3-MEDIUM", "홀_카운터")
        .when(ot == "4-NOT SPECIFIED", "배달").otherwise("배달_포장")
    )


@query("agg_generic", f"""WITH {LINES} SELECT store, platform, {big('sum(total_price)')} AS total_price_sum,
  {rnd('avg(total_price)', 4)} AS total_price_mean, min(sale_date)::VARCHAR AS sale_date_min, max(qty) AS qty_max,
  count(DISTINCT order_id) AS order_id_nunique FROM lines GROUP BY store, platform""")
def agg_generic(t):
    from tillbook.functions.numbers import rnd as r

    g = m.agg_generic(
        t.lines, ["store", "platform"],
        {"total_price": ["sum", "mean"], "sale_date": "min", "qty": "max", "order_id": "nunique"},
    )
    return g.withColumn("total_price_mean", r("total_price_mean", 4))


ACT = LINES + f""", hl AS (SELECT * REPLACE ({HALL} AS order_type) FROM lines), act0 AS (
  SELECT sale_date, ym, store, brand, {big('sum(total_price)')} AS total_sales,
    {big("COALESCE(sum(total_price) FILTER (order_type IN ('홀_테이블', '홀_포장', '홀_카운터')), 0)")} AS hall_sales,
    {big("COALESCE(sum(total_price) FILTER (order_type = '홀_테이블'), 0)")} AS hall_table_sales,
    {big("COALESCE(sum(total_price) FILTER (order_type IN ('홀_포장', '홀_카운터')), 0)")} AS hall_pack_sales,
    {big("COALESCE(sum(total_price) FILTER (NOT contains(order_type, '홀')), 0)")} AS delivery_sales,
    count(DISTINCT order_id) FILTER (order_type = '홀_테이블') AS tables FROM hl GROUP BY ALL), act AS (
  SELECT *, {rint(ratio('total_sales', 'tables'))} AS table_price,
    CASE WHEN isodow(sale_date) >= 6 THEN '주말' ELSE '평일' END AS day_kind FROM act0)"""


def actuals(t):
    return m.store_daily_actuals(t.lines.withColumn("order_type", hall_type()))


@query("store_daily_actuals", f"WITH {ACT} SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date) FROM act")
def store_daily_actuals(t):
    return actuals(t)


@query("store_platform_daily", f"""WITH {LINES}, g AS (SELECT sale_date, store, manager, count(DISTINCT order_id) AS total_order_count,
    {big('sum(total_price)')} AS total_amount, {big("sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END)")} AS settlement_amount,
    min(open_date)::VARCHAR AS open_date, string_agg(DISTINCT platform, ',' ORDER BY platform) AS platform FROM lines GROUP BY ALL)
  SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), {rnd(ratio('total_amount', 'total_order_count'), 4)} AS arpu FROM g""")
def store_platform_daily(t):
    return m.store_platform_daily(manager_lines(t))


@query("platform_pivot", f"""WITH {LINES} SELECT {D}, store, """ + ", ".join(
    f"""count(DISTINCT order_id) FILTER (platform = '{p}') AS "orders_{p}",
    {big(f"COALESCE(sum(total_price) FILTER (platform = '{p}'), 0)")} AS "amount_{p}",
    {big(f"COALESCE(sum(discount_amount) FILTER (platform = '{p}'), 0)")} AS "fee_{p}",
    {big(f"COALESCE(sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END) FILTER (platform = '{p}'), 0)")} AS "settlement_{p}" """
    for p in PLATFORMS) + " FROM lines GROUP BY sale_date, store")
def platform_pivot(t):
    return m.platform_pivot(manager_lines(t), PLATFORMS)


KINDS = ("view", "click", "purchase", "signup", "error")


@query("change_event_pivot", f"WITH {EVENTS} SELECT CAST(d AS VARCHAR) AS d, store, " + ", ".join(
    f"count(*) FILTER (event_type = '{k}') AS \"{k}\"" for k in KINDS) + " FROM ev GROUP BY d, store")
def change_event_pivot(t):
    return m.event_pivot(t.events, KINDS)


@query("ops_change_flags", f"WITH {EVENTS} SELECT CAST(d AS VARCHAR) AS d, store, " + ", ".join(
    f"max(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS {k}_flag" for k in ("signup", "error"))
    + ", min(event_id) AS first_event_id FROM ev GROUP BY d, store")
def ops_change_flags(t):
    return m.ops_change_flags(t.events, ("signup", "error"))


BIDS = EVENTS + """, bids AS (SELECT store, d, ts, event_id, amount AS bid_after, k * 100 AS bid_before FROM ev WHERE event_type IN ('click', 'view')),
  wk AS (SELECT store, date_trunc('week', d) AS w, min(bid_after) AS bid_after_min, max(bid_after) AS bid_after_max, {a} AS bid_after_mean,
    min(bid_before) AS bid_before_min, max(bid_before) AS bid_before_max, {b} AS bid_before_mean FROM bids GROUP BY ALL),
  lt AS (SELECT * FROM bids QUALIFY row_number() OVER (PARTITION BY store, d ORDER BY ts DESC, event_id DESC) = 1)""".format(
    a=rnd("avg(bid_after)"), b=rnd("avg(bid_before)"))


@query("bid_change_stats", f"""WITH {BIDS} SELECT lt.store, CAST(lt.d AS VARCHAR) AS d, lt.event_id, lt.bid_after, lt.bid_before,
  CAST(CAST(wk.w AS DATE) AS VARCHAR) AS week_start, bid_after_min, bid_after_max, bid_after_mean, bid_before_min, bid_before_max, bid_before_mean
  FROM lt JOIN wk ON wk.store = lt.store AND wk.w = date_trunc('week', lt.d)""")
def bid_change_stats(t):
    bids = t.events.where(F.col("event_type").isin("click", "view")).select(
        "store", "d", "ts", "event_id", F.col("amount").alias("bid_after"), (F.col("k") * 100).alias("bid_before")
    )
    return m.bid_change_stats(bids, ["bid_after", "bid_before"]).drop("ts")


@query("mean_excluding_zero", f"""WITH {EVENTS} SELECT store, event_type, COALESCE({rnd('avg(CASE WHEN k - 40 > 0 THEN k - 40 END)', 6)}, 0.0) AS mean_k
  FROM ev GROUP BY store, event_type""")
def mean_excluding_zero(t):
    from tillbook.functions.numbers import rnd as r

    return t.events.groupBy("store", "event_type").agg(r(m.mean_excluding_zero(F.col("k") - 40), 6).alias("mean_k"))


@query("hall_daily_kpi", f"""WITH {ACT}, g AS (SELECT sale_date, order_type, count(DISTINCT order_id) AS orders, {big('sum(total_price)')} AS sales
    FROM hl WHERE order_type IN ('홀_테이블', '홀_포장') AND sale_type <> '취소' GROUP BY ALL)
  SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), COALESCE({rnd(ratio('sales', 'orders'))}, 0.0) AS ticket FROM g""")
def hall_daily_kpi(t):
    return m.hall_daily_kpi(t.lines.withColumn("order_type", hall_type()), ["홀_테이블", "홀_포장"])


WEEKLY_SLOTS = SLOTS + f""", ws0 AS (SELECT ym, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
    {big('sum(order_amount)')} AS sales, count(*) AS orders, {big("COALESCE(sum(order_amount) FILTER (time_slot = '점심'), 0)")} AS lunch_sales,
    count(*) FILTER (time_slot = '점심') AS lunch_orders, {big("COALESCE(sum(order_amount) FILTER (time_slot = '저녁'), 0)")} AS dinner_sales,
    count(*) FILTER (time_slot = '저녁') AS dinner_orders FROM slots GROUP BY ALL),
  ws AS (SELECT *, {rint(ratio('sales', 'orders'))} AS ticket, {rint(ratio('lunch_sales', 'lunch_orders'))} AS lunch_ticket,
    {rint(ratio('dinner_sales', 'dinner_orders'))} AS dinner_ticket FROM ws0 WHERE week_start + 6 < DATE '{AS_OF}')"""


def weekly_slots(t):
    return m.hall_weekly_slots(slotted(t).withColumn("order_cnt", F.lit(1)), AS_OF, "order_amount")


@query("hall_weekly_slots", f"WITH {WEEKLY_SLOTS} SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM ws")
def hall_weekly_slots(t):
    return weekly_slots(t)


@query("complete_weeks_only", f"""WITH {HEADS} SELECT CAST(CAST(date_trunc('week', sale_date) AS DATE) AS VARCHAR) AS week_start, store,
  {big('sum(order_amount)')} AS sales FROM heads WHERE sale_date < date_trunc('week', DATE '{AS_OF}') GROUP BY ALL""")
def complete_weeks_only(t):
    from tillbook.operators.filters import complete_weeks_only as keep

    return keep(t.heads, "sale_date", AS_OF).groupBy(
        F.date_trunc("week", "sale_date").cast("date").alias("week_start"), "store"
    ).agg(F.sum("order_amount").alias("sales"))


# The channel whose reviews carry no id.
IDLESS = "src0"
DEDUP = REVIEWS + """, dd AS (SELECT * FROM rev WHERE channel <> '{c}' OR channel IS NULL UNION ALL
  SELECT * FROM (SELECT * FROM rev WHERE channel = '{c}' QUALIFY row_number() OVER (PARTITION BY d, store, text, topic, sentiment ORDER BY doc_id) = 1))"""


@query("review_topic_counts", f"""WITH {DEDUP.format(c=IDLESS)}, f AS (SELECT d, store, topic, sentiment, doc_id FROM dd
    UNION ALL SELECT DATE '2024-01-31', store, topic, sentiment, doc_id FROM dd WHERE d = DATE '2024-01-30' AND NOT EXISTS (SELECT 1 FROM dd WHERE d = DATE '2024-01-31'))
  SELECT CAST(d AS VARCHAR) AS d, store, topic, sentiment, count(*) AS mentions FROM f GROUP BY ALL""")
def review_topic_counts(t):
    rows = m.review_dedup(t.reviews, IDLESS, ["doc_id"], ["d", "store", "text", "topic", "sentiment"], ["doc_id"])
    return m.review_topic_counts(m.fill_target_day(rows, "d", "2024-01-31"))


@query("review_daily_counts", f"""WITH {REVIEWS}, dup AS (SELECT * FROM rev UNION ALL SELECT * FROM rev WHERE toxic = 1)
  SELECT CAST(d AS VARCHAR) AS d, store, channel, CASE WHEN channel = '{IDLESS}' THEN count(*) ELSE count(DISTINCT doc_id) END AS reviews
  FROM dup GROUP BY d, store, channel""")
def review_daily_counts(t):
    rows = t.reviews.unionByName(t.reviews.where(F.col("toxic") == 1))
    return m.review_daily_counts(rows, IDLESS)


@query("voc_store_summary", f"""WITH {REVIEWS}, g AS (SELECT d, manager, store, count(DISTINCT text) AS reviews,
    count(DISTINCT text) FILTER (sentiment = 'negative') AS negatives FROM rev GROUP BY ALL),
  w AS (SELECT *, {tint(roll('sum', 'negatives', 'manager, store', 'd', -29))} AS sum_30d_recent,
    {tint(roll('sum', 'negatives', 'manager, store', 'd', -59, -30))} AS sum_30d_prev FROM g)
  SELECT * REPLACE (CAST(d AS VARCHAR) AS d), {pct('sum_30d_recent', 'sum_30d_prev', 4)} AS pct_change_30d FROM w""")
def voc_store_summary(t):
    return m.voc_store_summary(t.reviews, F.sha2("text", 256))


@query("voc_topic_negatives", f"WITH {REVIEWS} SELECT CAST(d AS VARCHAR) AS d, store, topic, count(*) AS negatives FROM rev WHERE sentiment = 'negative' GROUP BY d, store, topic")
def voc_topic_negatives(t):
    return m.voc_topic_negatives(t.reviews)


TICKETS = EVENTS + """, tk AS (SELECT CAST(user_id AS VARCHAR) AS ticket, event_id, ts AS uploaded_at, d AS collected,
    CASE WHEN k % 4 = 0 THEN '완료' WHEN k % 4 = 1 THEN '진행' ELSE '접수' END AS status, CASE WHEN k % 3 = 0 THEN NULL ELSE event_type END AS issue_type,
    CASE WHEN k % 5 = 0 THEN 'memo ' || k ELSE '' END AS memo, CASE WHEN k % 2 = 0 THEN store END AS store,
    CAST(d - CAST(k % 10 AS INTEGER) AS DATE) AS registered FROM ev)"""


def tickets(t):
    k = F.col("k")
    return t.events.select(
        F.col("user_id").cast("string").alias("ticket"), "event_id", F.col("ts").alias("uploaded_at"), F.col("d").alias("collected"),
        F.when(k % 4 == 0, "완료").when(k % 4 == 1, "진행").otherwise("접수").alias("status"),
        F.when(k % 3 != 0, F.col("event_type")).alias("issue_type"),
        F.when(k % 5 == 0, F.concat(F.lit("memo "), k)).otherwise("").alias("memo"),
        F.when(k % 2 == 0, F.col("store")).alias("store"),
        F.date_sub("d", (k % 10).cast("int")).alias("registered"),
    )


CSMART = TICKETS + """, cs0 AS (SELECT ticket, arg_max(issue_type, uploaded_at) FILTER (issue_type IS NOT NULL) AS issue_type,
    arg_max(store, uploaded_at) FILTER (store IS NOT NULL) AS store, arg_max(status, uploaded_at) AS status, min(registered) AS registered,
    CAST(min(uploaded_at) FILTER (status = '완료') AS DATE) AS du, min(collected) FILTER (memo <> '') AS first_memo FROM tk GROUP BY ticket),
  cs AS (SELECT ticket, issue_type, store, status, registered, first_memo, CASE WHEN status = '완료' THEN 1 ELSE 0 END AS is_done,
    CASE WHEN status = '완료' THEN COALESCE(first_memo, du) END AS done_date,
    CASE WHEN CAST(ticket AS BIGINT) >= 20 THEN greatest(date_diff('day', registered, COALESCE(first_memo, DATE '2024-02-01')), 0) END AS duration_days,
    strftime(registered, '%Y-%m') AS month, strftime(registered, '%b-%y') AS month_label, year(registered) * 100 + month(registered) AS month_sort FROM cs0)"""


def cs_mart(t):
    return m.cs_issue_mart(tickets(t), ["issue_type", "store"], "2024-02-01", 20)


@query("cs_issue_mart", f"""WITH {CSMART} SELECT * REPLACE (CAST(registered AS VARCHAR) AS registered, CAST(first_memo AS VARCHAR) AS first_memo,
  CAST(done_date AS VARCHAR) AS done_date) FROM cs""")
def cs_issue_mart(t):
    return cs_mart(t)


@query("cs_month_stats", f"""WITH {CSMART}, b AS (SELECT month, count(*) AS total, {big('sum(is_done)')} AS done, {rnd('avg(duration_days)', 1)} AS avg_days FROM cs GROUP BY month),
  c0 AS (SELECT month, issue_type, count(*) AS n FROM cs WHERE issue_type IS NOT NULL GROUP BY ALL),
  c AS (SELECT * FROM c0 QUALIFY row_number() OVER (PARTITION BY month ORDER BY n DESC, issue_type) <= 3),
  s AS (SELECT month, string_agg(issue_type || '(' || n || '건)', ', ' ORDER BY n DESC, issue_type) AS issue_types FROM c GROUP BY month)
  SELECT b.*, {rint(ratio('done', 'total') + ' * 100')} AS done_rate, COALESCE(issue_types, '-') AS issue_types FROM b LEFT JOIN s USING (month)""")
def cs_month_stats(t):
    return m.cs_month_stats(cs_mart(t))


@query("cs_daily_completion", f"""WITH {TICKETS}, f AS (SELECT ticket, min(registered) AS reg, min(collected) FILTER (memo <> '') AS mm FROM tk GROUP BY ticket),
  a AS (SELECT mm AS collected, {rnd("avg(greatest(date_diff('day', reg, mm), 0))")} AS avg_response_days FROM f WHERE mm IS NOT NULL GROUP BY mm),
  d AS (SELECT collected, count(DISTINCT ticket) AS total, count(DISTINCT ticket) FILTER (status = '완료') AS done FROM tk GROUP BY collected)
  SELECT CAST(d.collected AS VARCHAR) AS collected, total, done, avg_response_days, COALESCE({rnd(ratio('done', 'total') + ' * 100', 1)}, 0.0) AS done_rate
  FROM d LEFT JOIN a ON a.collected = d.collected""")
def cs_daily_completion(t):
    return m.cs_daily_completion(tickets(t))


MENU = LINES + """, ms AS (SELECT ym, store, p.p_name AS menu, p.p_type AS category, qty, net_amount AS sales FROM lines l JOIN part p ON p.p_partkey = l.l_partkey),
  smq AS (SELECT ym, store, menu, category, CAST(sum(qty) AS BIGINT) AS store_qty, CAST(sum(sales) AS BIGINT) AS store_sales FROM ms GROUP BY ALL)"""


def menu_sales(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("menu"), F.col("p_type").alias("category"))
    return t.lines.join(p, "l_partkey").select("ym", "store", "menu", "category", "qty", F.col("net_amount").alias("sales"))


@query("menu_store_agg", f"""WITH {MENU}, pr AS (SELECT ym, menu, {rnd('avg(store_qty)', 4)} AS avg_qty, {rnd('avg(store_sales)', 4)} AS avg_sales,
    count(DISTINCT store) AS stores FROM smq GROUP BY ym, menu)
  SELECT s.*, avg_qty, avg_sales, stores, rank() OVER (PARTITION BY s.ym, s.menu ORDER BY store_qty DESC) AS qty_rank,
    rank() OVER (PARTITION BY s.ym, s.menu ORDER BY store_sales DESC) AS sales_rank FROM smq s JOIN pr USING (ym, menu)""")
def menu_store_agg(t):
    return m.menu_store_agg(menu_sales(t))


@query("menu_store_summary", f"""WITH {MENU}, g AS (SELECT ym, store, {big('sum(store_qty)')} AS total_qty, {big('sum(store_sales)')} AS total_sales,
    count(DISTINCT menu) AS menus FROM smq GROUP BY ym, store),
  tq AS (SELECT ym, store, menu AS top_qty_menu, store_qty AS top_qty FROM smq QUALIFY row_number() OVER (PARTITION BY ym, store ORDER BY store_qty DESC, store_sales DESC, menu DESC, category DESC) = 1),
  ts AS (SELECT ym, store, menu AS top_sales_menu, store_sales AS top_sales FROM smq QUALIFY row_number() OVER (PARTITION BY ym, store ORDER BY store_sales DESC, store_qty DESC, menu DESC, category DESC) = 1)
  SELECT g.*, top_qty_menu, top_qty, top_sales_menu, top_sales, count(*) OVER (PARTITION BY ym) AS stores,
    rank() OVER (PARTITION BY ym ORDER BY total_qty DESC) AS qty_rank, rank() OVER (PARTITION BY ym ORDER BY total_sales DESC) AS sales_rank
  FROM g JOIN tq USING (ym, store) JOIN ts USING (ym, store)""")
def menu_store_summary(t):
    return m.menu_store_summary(m.menu_store_agg(menu_sales(t)))


TOTAL = MENU + f""", mt AS (SELECT ym, menu, category, {big('sum(qty)')} AS qty, {big('sum(sales)')} AS sales FROM ms GROUP BY ALL)"""


@query("menu_total_agg", f"""WITH {TOTAL} SELECT *, rank() OVER (PARTITION BY ym ORDER BY qty DESC) AS qty_rank, rank() OVER (PARTITION BY ym ORDER BY sales DESC) AS sales_rank,
  rank() OVER (PARTITION BY ym, category ORDER BY qty DESC) AS cat_qty_rank, rank() OVER (PARTITION BY ym, category ORDER BY sales DESC) AS cat_sales_rank,
  COALESCE({rnd(ratio('qty', 'sum(qty) OVER (PARTITION BY ym, category)') + ' * 100', 1)}, 0.0) AS cat_qty_share,
  COALESCE({rnd(ratio('sales', 'sum(sales) OVER (PARTITION BY ym, category)') + ' * 100', 1)}, 0.0) AS cat_sales_share FROM mt""")
def menu_total_agg(t):
    return m.menu_total_agg(menu_sales(t))


@query("menu_month_category", f"""WITH {MENU} SELECT ym, category, store, {big('sum(sales)')} AS sales FROM ms GROUP BY ym, category, store
  UNION ALL SELECT ym, category, NULL, {big('sum(sales)')} FROM ms GROUP BY ym, category""")
def menu_month_category(t):
    return m.menu_month_category(menu_sales(t))


@query("group_rank", f"""WITH {LINES}, g AS (SELECT item_id, {big('sum(net_amount)')} AS sales, {big('sum(qty)')} AS qty FROM lines GROUP BY item_id)
  SELECT item_id, sales, qty, rank() OVER (ORDER BY sales DESC) AS sales_rank, rank() OVER (ORDER BY qty DESC) AS qty_rank FROM g""")
def group_rank(t):
    from tillbook.operators.core import global_rank

    g = t.raw_lines.groupBy(F.col("l_partkey").cast("string").alias("item_id")).agg(
        F.sum("net_amount").alias("sales"), F.sum("qty").alias("qty")
    )
    return global_rank(global_rank(g, "sales", "sales_rank"), "qty", "qty_rank")


FUNNEL = EVENTS + f""", fn AS (SELECT store, CAST(date_trunc('week', d) AS DATE) AS week_start,
    {big("COALESCE(sum(amount) FILTER (event_type = 'click'), 0)")} AS spend, count(*) FILTER (event_type = 'view') AS impressions,
    count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS orders,
    {big("COALESCE(sum(amount) FILTER (event_type = 'purchase'), 0)")} AS revenue FROM ev GROUP BY ALL)"""


@query("ad_weekly_funnel", f"""WITH {FUNNEL} SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start), {rnd(ratio('clicks', 'impressions') + ' * 100')} AS ctr,
  {rnd(ratio('orders', 'clicks') + ' * 100')} AS cvr, {rnd(ratio('revenue', 'spend') + ' * 100')} AS roas, """ + ", ".join(
    f"{pct(c, f'lag({c}) OVER (PARTITION BY store ORDER BY week_start)', 1)} AS {c}_wow_pct" for c in ("spend", "clicks", "orders", "revenue")) + " FROM fn")
def ad_weekly_funnel(t):
    return m.ad_weekly_funnel(t.events)


@query("low_weekdays", f"""WITH {HEADS}, dl AS (SELECT store, sale_date, count(*) AS orders FROM heads GROUP BY ALL),
  g AS (SELECT store, CAST(isodow(sale_date) - 1 AS BIGINT) AS weekday, {rnd('avg(orders)', 4)} AS avg_orders FROM dl GROUP BY ALL)
  SELECT *, row_number() OVER (PARTITION BY store ORDER BY avg_orders, weekday) AS rank FROM g QUALIFY rank <= 2""")
def low_weekdays(t):
    return m.low_weekdays(t.heads.groupBy("store", "sale_date").agg(F.count(F.lit(1)).alias("orders")))


@query("first_sale_date", f"""WITH {LINES}, fs AS (SELECT source, item_id, min(sale_date) AS first_sale_date FROM lines GROUP BY ALL),
  md AS (SELECT 'F' AS source, CAST(p_partkey AS VARCHAR) AS item_id, CAST(DATE '1996-01-01' + CAST(p_size AS INTEGER) AS DATE) AS first_master_date FROM part
    UNION ALL SELECT 'M', CAST(p_partkey AS VARCHAR), CAST(DATE '1997-01-01' + CAST(p_size AS INTEGER) AS DATE) FROM part)
  SELECT source, item_id, CAST(COALESCE(first_sale_date, first_master_date) AS VARCHAR) AS launch_date FROM fs FULL JOIN md USING (source, item_id)""")
def first_sale_date(t):
    p = t.products
    md = lambda src, d0: p.select(
        F.lit(src).alias("source"), F.col("code").alias("item_id"), F.date_add(F.lit(d0).cast("date"), F.col("size")).alias("first_master_date")
    )
    return m.launch_dates(m.first_sale_date(t.lines), md("F", "1996-01-01").unionByName(md("M", "1997-01-01")))


@query("label_conflicts", f"""WITH {PRODUCTS}, c AS (SELECT name, count(DISTINCT label) AS label_count, string_agg(DISTINCT label, '|' ORDER BY label) AS labels
    FROM products WHERE brand <> 'Brand#9' GROUP BY name HAVING count(DISTINCT label) > 1)
  SELECT p.code, p.name, c.label_count, c.labels, CASE WHEN c.name IS NULL THEN 'N' ELSE 'Y' END AS conflict FROM products p LEFT JOIN c USING (name)""")
def label_conflicts(t):
    c = m.label_conflicts(t.products.where(F.col("brand") != "Brand#9"), ["name"], "label")
    flagged = m.flag_conflicts(t.products.select("code", "name"), c, ["name"])
    return flagged.join(c, "name", "left")


EVID = LINES + """, il AS (SELECT l.store, l.source, l.item_id, p.p_brand AS brand, CAST(round(l.unit_price / 1000) AS BIGINT) AS unit_price,
    CASE WHEN l.l_linenumber > 4 THEN NULL ELSE CAST(l.l_linenumber AS VARCHAR) END AS menu
  FROM lines l JOIN part p ON p.p_partkey = l.l_partkey), n AS (SELECT store, source, item_id, menu, count(*) AS n FROM il GROUP BY ALL),
  b AS (SELECT store, source, item_id, CAST(sum(n) AS BIGINT) AS rows, count(menu) AS menu_count FROM n GROUP BY ALL),
  s AS (SELECT store, source, item_id, string_agg(menu, ' | ' ORDER BY n DESC, menu) AS menu_sample, first(menu ORDER BY n DESC, menu) AS representative_menu FROM (
    SELECT * FROM n WHERE menu IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store, source, item_id ORDER BY n DESC, menu) <= 2) GROUP BY ALL),
  br0 AS (SELECT store, source, item_id, brand, count(*) AS n FROM il GROUP BY ALL),
  br AS (SELECT * FROM br0 QUALIFY row_number() OVER (PARTITION BY store, source, item_id ORDER BY n DESC, brand) = 1),
  pr0 AS (SELECT store, source, item_id, unit_price, count(*) AS n FROM il GROUP BY ALL),
  pr AS (SELECT * FROM pr0 QUALIFY row_number() OVER (PARTITION BY store, source, item_id ORDER BY n DESC, unit_price) = 1)"""


@query("item_evidence", f"""WITH {EVID}, e AS (SELECT b.store, b.source, b.item_id, b.rows, b.menu_count, coalesce(s.menu_sample, '') AS menu_sample, coalesce(s.representative_menu, '') AS representative_menu,
    br.brand AS common_brand, pr.unit_price AS common_price, CASE WHEN menu_count = 1 THEN 'high' WHEN menu_count > 1 THEN 'low' ELSE '' END AS confidence,
    CASE common_price % 5 WHEN 0 THEN '메인' WHEN 1 THEN '기타' WHEN 2 THEN '음료' WHEN 3 THEN '1인' ELSE '' END AS label
    FROM b LEFT JOIN s USING (store, source, item_id) JOIN br USING (store, source, item_id) JOIN pr USING (store, source, item_id))
  SELECT * EXCLUDE (label), CASE WHEN common_price % 7 = 0 THEN '' ELSE concat_ws(', ', CASE WHEN menu_count = 0 THEN '표준명 미입력' END, CASE WHEN label = '' THEN '수동분류 미입력' END,
      CASE WHEN label = '기타' THEN '기타 분류 확인' END, CASE WHEN menu_count > 1 AND label IN ('메인', '1인') THEN '부모메뉴 후보 다수' END,
      CASE WHEN common_price % 3 = 0 AND menu_count > 0 AND (label = '음료' OR (label IN ('메인', '1인') AND menu_count = 1)) THEN 'LLM 분류 확인' END) END AS review_reasons FROM e""")
def item_evidence(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    il = t.lines.drop("brand").join(p, "l_partkey").select(
        "store", "source", "item_id", "brand", F.round(F.col("unit_price") / 1000).cast("bigint").alias("unit_price"),
        F.when(F.col("l_linenumber") > 4, " ").otherwise(F.col("l_linenumber").cast("string")).alias("menu"),
    )
    found = m.item_evidence(il, ["store", "source", "item_id"], "menu", top=2)
    of = F.col("common_price") % 5
    label = F.when(of == 0, "메인").when(of == 1, "기타").when(of == 2, "음료").when(of == 3, "1인")
    by, seen = F.when(F.col("common_price") % 3 == 0, "llm"), F.when(F.col("common_price") % 7 == 0, "y")
    return found.withColumn("review_reasons", review_reasons("representative_menu", label, "menu_count", seen, by))


@query("sheet_group_sum", f"""WITH {HEADS} SELECT platform, {big('sum(o_orderkey)')} AS o_orderkey, {big('sum(order_amount)')} AS order_amount
  FROM heads GROUP BY platform""")
def sheet_group_sum(t):
    rows = t.heads.select("platform", "o_orderkey", "order_amount", "store")
    total = rows.select(F.lit("합계").alias("platform"), "o_orderkey", "order_amount", "store")
    return m.sheet_group_sum(rows.unionByName(total), "platform")


@query("coverage_summary", f"""WITH {HEADS} SELECT ym, platform, h.store, count(*) AS rows,
  {rnd('avg(CASE WHEN l.l_orderkey IS NULL THEN 1.0 ELSE 0.0 END)', 4)} AS l_orderkey_null_rate
  FROM heads h LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON l.l_orderkey = h.o_orderkey GROUP BY ALL""")
def coverage_summary(t):
    keys = t.table("lineitem").select("l_orderkey").distinct()
    h = t.heads.join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return m.coverage_summary(h, ["ym", "platform", "store"], ["l_orderkey"])


@query("coupon_flag", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN max(l_discount) OVER (PARTITION BY l_orderkey) > 0.08 THEN 'Y' ELSE 'N' END AS coupon_yn
  FROM lineitem""")
def coupon_flag(t):
    coupon = F.when(F.col("l_discount") > 0.08, 1).otherwise(0)
    rows = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", coupon.alias("coupon"))
    return m.coupon_flag(rows, "l_orderkey", "coupon").drop("coupon")


@query("wide_to_long", f"""WITH {LINES} SELECT {D}, store, CASE WHEN platform IN ('AUTOMOBILE', 'MACHINERY') THEN 'GARAGE' ELSE platform END AS platform,
  {big('sum(total_price)')} AS amount FROM (SELECT sale_date, store, platform, sum(total_price) AS total_price FROM lines GROUP BY ALL HAVING sum(total_price) <> 0)
  GROUP BY 1, 2, 3""")
def wide_to_long(t):
    wide = t.lines.groupBy("sale_date", "store").pivot("platform", list(PLATFORMS)).agg(F.sum("total_price"))
    return m.wide_to_long(
        wide, ["sale_date", "store"], PLATFORMS, "platform", "amount", {"AUTOMOBILE": "GARAGE", "MACHINERY": "GARAGE"}
    )


@query("unpivot_accounts", f"""WITH {HEADS} SELECT store, platform, {big('count(DISTINCT c_custkey)')} AS accounts FROM heads JOIN orders o ON o.o_orderkey = heads.o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY store, platform""")
def unpivot_accounts(t):
    o = t.table("orders").select("o_orderkey", "o_custkey")
    wide = t.heads.join(o, "o_orderkey").groupBy("store").pivot("platform", list(PLATFORMS)).agg(F.countDistinct("o_custkey"))
    return m.wide_to_long(wide, ["store"], PLATFORMS, "platform", "accounts")


@query("input_completeness", f"""WITH {HEADS}, g AS (SELECT s.store, CAST(d AS DATE) AS sale_date FROM stores s,
    generate_series(DATE '{AS_OF}' - INTERVAL 7 DAY, DATE '{AS_OF}' - INTERVAL 1 DAY, INTERVAL 1 DAY) x(d)),
  dl AS (SELECT store, sale_date, {big("COALESCE(sum(order_amount) FILTER (platform = 'BUILDING'), 0)")} AS amt, count(*) FILTER (source = 'F') AS n FROM heads GROUP BY ALL),
  r AS (SELECT g.*, CASE WHEN dl.store IS NULL THEN 'missing' WHEN amt = 0 AND n = 0 THEN 'all_zero' END AS issue FROM g LEFT JOIN dl USING (store, sale_date))
  SELECT store, {D}, issue FROM r WHERE issue IS NOT NULL""")
def input_completeness(t):
    dl = t.heads.groupBy("store", "sale_date").agg(
        F.coalesce(F.sum(F.when(F.col("platform") == "BUILDING", F.col("order_amount"))), F.lit(0)).alias("amt"),
        F.count(F.when(F.col("source") == "F", 1)).alias("n"),
    )
    return m.input_completeness(dl, t.stores, AS_OF, ["amt", "n"])


@query("collection_status", f"""WITH {HEADS}, g AS (SELECT s.manager, s.store, p.platform FROM stores s, (SELECT DISTINCT platform FROM heads) p),
  got AS (SELECT DISTINCT store, platform FROM heads WHERE sale_date = DATE '{AS_OF}'),
  j AS (SELECT g.*, got.store AS hit FROM g LEFT JOIN got USING (store, platform))
  SELECT manager, count(*) AS expected, count(hit) AS collected, count(*) FILTER (hit IS NULL) AS missing,
    COALESCE(string_agg(store || ':' || platform, ',' ORDER BY store || ':' || platform) FILTER (hit IS NULL), '') AS missing_list FROM j GROUP BY manager""")
def collection_status(t):
    return m.collection_status(t.stores, PLATFORMS, t.heads.where(F.col("sale_date") == AS_OF))
