"""Source jobs: raw exports to unified lines, master tables."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, LINE_SEQ, LINES, PRODUCTS, STORES, big, query, ratio, rint, rnd
from tillbook.catalog.c06_order_lines import NAME, adjust_sql, item_name, remainder_sql, segments_sql
from tillbook.functions.clean import item_key
from tillbook.plans import master as ms, unify as u
from tillbook.sources.fixtures import AS_OF, LINE_ORDER

T = lambda x: F.col(x).cast("string")


def master_full(t):
    return t.products.select(
        "code", "name", F.when(F.col("label").isin("LARGE", "ECONOMY"), "Y").otherwise("N").alias("is_main_candidate"),
        F.when(F.col("brand") == "Brand#3", "Y").otherwise("N").alias("exclude_check"),
    )


MASTER = """mst AS (SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_type IN ('LARGE', 'ECONOMY') AND p_brand <> 'Brand#3' AS main FROM part)"""


def pk_sql(source, store="store"):
    return f"""md5(concat_ws('|', CAST(sale_date AS VARCHAR), '{source}', {store}, platform, order_id, CAST(item_seq AS VARCHAR)))"""


# -- receipts -----------------------------------------------------------------

R1 = LINES + ", " + MASTER + f""", r0 AS (SELECT h.o_orderkey, h.sale_date, h.ym, 'BRAND ' || h.store AS store, h.region, h.manager, h.open_date, CAST(h.o_orderkey % 5 AS VARCHAR) AS pos, h.order_id AS receipt,
    CASE WHEN h.source = 'P' THEN '취소' ELSE '정상' END AS sale_type, CASE WHEN h.source = 'P' THEN -h.order_amount ELSE h.order_amount END AS order_amount,
    CASE WHEN h.o_orderkey % 9 = 0 THEN '' ELSE h.order_time END AS order_time,
    CASE h.platform WHEN 'BUILDING' THEN 'POS' WHEN 'FURNITURE' THEN 'PARTNER' WHEN 'HOUSEHOLD' THEN 'PHONE' ELSE h.platform END AS ch,
    CASE WHEN h.order_type IN ('1-URGENT', '2-HIGH') THEN '포장' WHEN h.order_type = '3-MEDIUM' THEN '홀(매장)' ELSE '배달' END AS ok,
    CASE h.o_orderkey % 4 WHEN 0 THEN '포장2' WHEN 1 THEN CAST(h.o_orderkey % 30 AS VARCHAR) WHEN 2 THEN '배달-01' ELSE '' END AS tb,
    l.item_id, CASE WHEN l.l_orderkey IS NOT NULL THEN {NAME.replace('l_partkey', 'l.l_partkey')} END AS item_name, COALESCE(l.qty, 0) AS qty, COALESCE(l.net_amount, h.order_amount) AS amount,
    COALESCE(l.discount_amount, 0) AS disc, row_number() OVER (PARTITION BY h.o_orderkey ORDER BY {', '.join('l.' + c for c in LINE_ORDER)}) AS item_seq
  FROM heads h LEFT JOIN lines l ON l.o_orderkey = h.o_orderkey),
  r1 AS (SELECT r0.*, COALESCE(m.main, false) AS main, CASE WHEN qty > 0 THEN CAST(amount AS DOUBLE) / qty ELSE amount END AS price,
    ((regexp_full_match(tb, '\\d+') OR contains(tb, '포장')) AND NOT contains(tb, '배달')) OR (regexp_matches(ok, '홀|포장|매장') AND NOT contains(ok, '배달')) AS is_hall FROM r0 LEFT JOIN mst m ON m.code = r0.item_id)
  {segments_sql('r1', 'main', 'price', 'is_hall', 'o_orderkey')},
  r2 AS (SELECT *, CASE WHEN ch IN ('POS', 'PARTNER') AND (contains(tb, '포장') OR regexp_full_match(tb, '\\d+')) THEN '홀' ELSE ch END AS platform,
    CASE WHEN ch IN ('POS', 'PARTNER') AND contains(tb, '포장') THEN '홀_포장' WHEN ch IN ('POS', 'PARTNER') AND regexp_full_match(tb, '\\d+') THEN '홀_테이블'
      WHEN ch IN ('POS', 'PARTNER') AND contains(tb, '배달') THEN '배달' ELSE ok END AS o1 FROM seg),
  r3 AS (SELECT o_orderkey, sale_date, ym, store, region, manager, open_date, pos, receipt, sale_type, order_amount, order_time, platform, menu, item_seq, item_id, item_name, qty, amount,
    CASE WHEN platform = 'PHONE' AND o1 = '포장' THEN '홀_포장' WHEN platform NOT IN ('POS', 'PARTNER', '홀') AND o1 = '포장' THEN '배달_포장' WHEN o1 IN ('홀_테이블', '홀_포장', '배달_포장', '배달') THEN o1 ELSE '홀_테이블' END AS order_type,
    {rint('price')} AS unit_price, CASE WHEN sale_type = '취소' THEN -amount ELSE amount END AS total_price, CASE WHEN sale_type = '취소' THEN -disc ELSE disc END AS discount_amount,
    CASE WHEN item_seq <> max(item_seq) OVER (PARTITION BY o_orderkey) THEN 0 WHEN sale_type = '취소' THEN -1 ELSE 1 END AS order_cnt FROM r2)
  {adjust_sql('r3', 'o_orderkey')},
  r4 AS (SELECT * FROM r3 UNION ALL SELECT o_orderkey, sale_date, ym, store, region, manager, open_date, pos, receipt, CASE WHEN head - s >= 0 THEN '정상' ELSE '취소' END, order_amount, order_time, platform, menu,
    mx + 1, '__ADJ__', '정산차액', 1, 0, order_type, abs(head - s), head - s, 0, 0 FROM d0 JOIN rp USING (o_orderkey) WHERE head <> s),
  od AS (SELECT o_orderkey, sale_date, store, pos, receipt, max(menu) AS any_menu, arg_min(menu, item_seq) AS m, abs(sum(amount)) AS t FROM r4 GROUP BY ALL),
  ba AS (SELECT sale_date, store, t, m AS a FROM od WHERE any_menu IS NOT NULL AND t > 0 QUALIFY row_number() OVER (PARTITION BY sale_date, store, t ORDER BY pos, receipt) = 1),
  br AS (SELECT store, pos, receipt, m AS b FROM od WHERE any_menu IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store, pos, receipt ORDER BY sale_date) = 1),
  fi AS (SELECT od.o_orderkey, COALESCE(ba.a, br.b) AS found FROM od LEFT JOIN ba USING (sale_date, store, t) LEFT JOIN br ON br.store = od.store AND br.pos = od.pos AND br.receipt = od.receipt WHERE od.any_menu IS NULL),
  r5 AS (SELECT r4.* REPLACE (COALESCE(r4.menu, fi.found, '') AS menu), split_part(store, ' ', -1) || '_' || pos || CASE WHEN order_time <> '' THEN '-' ELSE '_' END || receipt || '_' || CASE WHEN order_time <> '' THEN order_time ELSE '00:00:00' END AS order_id
    FROM r4 LEFT JOIN fi USING (o_orderkey))"""


@query("unify_receipts", f"""WITH {R1} SELECT CAST(sale_date AS VARCHAR) AS sale_date, ym, 'pos_a' AS source, '' AS brand, store, region, manager, CAST(open_date AS VARCHAR) AS open_date, platform, order_type, order_id, order_time,
  menu AS menu_name, item_seq, COALESCE(item_id, '') AS item_id, COALESCE(mst.name, item_name, '') AS item_name, qty, unit_price, total_price, discount_amount, sale_type, {pk_sql('pos_a')} AS _pk, order_cnt
  FROM r5 LEFT JOIN mst ON mst.code = r5.item_id""")
def unify_receipts(t):
    k, p = F.col("o_orderkey"), F.col("platform")
    store, pos = F.concat(F.lit("BRAND "), "store"), (k % 5).cast("string")
    heads = t.heads.select(
        "sale_date", store.alias("store"), F.concat(F.lit("0"), pos).alias("pos_no"), F.concat(F.lit("00"), "order_id").alias("receipt_no"),
        F.when(F.col("source") == "P", "반품").otherwise("매출").alias("kind"),
        F.when(p == "BUILDING", "POS").when(p == "FURNITURE", "PARTNER").when(p == "HOUSEHOLD", "PHONE").otherwise(p).alias("channel"),
        F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").when(F.col("order_type") == "3-MEDIUM", "홀(매장)").otherwise("배달").alias("order_kind"),
        F.when(k % 4 == 0, "포장2").when(k % 4 == 1, (k % 30).cast("string")).when(k % 4 == 2, "배달-01").otherwise("").alias("table_name"),
        F.when(F.col("source") == "P", -F.col("order_amount")).otherwise(F.col("order_amount")).alias("actual_amount"),
        F.when(k % 9 == 0, "").otherwise(F.col("order_time")).alias("order_time"),
    )
    items = t.lines.select(
        "sale_date", store.alias("store"), pos.alias("pos_no"), F.col("order_id").alias("receipt_no"), "item_id", item_name().alias("item_name"),
        "qty", F.col("net_amount").alias("amount"), "discount_amount", *LINE_ORDER,
    )
    return u.unify_receipts(heads, items, t.stores, master_full(t), LINE_ORDER, ["POS", "PARTNER"], "PHONE")


# -- delivery feed ------------------------------------------------------------

FNAME = f"CASE WHEN l_partkey % 50 = 13 THEN '홀_ITEM' ELSE {NAME} END"
R2 = LINES + f""", f0 AS (SELECT l.*, {FNAME} AS nm, (o_orderkey % 3) * 1000 AS fee, CASE WHEN o_orderkey % 10 = 0 THEN order_amount ELSE 0 END AS dsc, order_amount - 500 AS paid,
    CASE WHEN o_orderkey % 6 = 0 THEN 'tmp_' || store || '_' || order_time ELSE 'X' || order_id END AS oid, order_type IN ('1-URGENT', '2-HIGH') AS pack,
    CASE WHEN source = 'P' THEN '취소' ELSE '정상' END AS st FROM lines l),
  f1 AS (SELECT *, greatest(CASE WHEN platform = 'AUTOMOBILE' THEN CASE WHEN pack THEN order_amount - 2000 ELSE order_amount END WHEN platform = 'BUILDING' THEN paid - fee
    WHEN platform = 'FURNITURE' THEN CASE WHEN order_amount = dsc THEN 0 WHEN fee > 0 THEN order_amount - fee ELSE order_amount END
    WHEN platform = 'HOUSEHOLD' THEN CASE WHEN o_orderkey % 7 = 0 AND fee > 0 THEN order_amount - fee ELSE order_amount END ELSE paid END, 0) AS revenue FROM f0 WHERE nm <> ''),
  f2 AS (SELECT *, sum(list_amount) OVER (PARTITION BY o_orderkey) AS tot, row_number() OVER (PARTITION BY oid ORDER BY l_orderkey, {LINE_SEQ}) AS item_seq FROM f1),
  f3 AS (SELECT *, CASE WHEN tot = 0 THEN 0 WHEN tot = revenue THEN list_amount ELSE {rint('CAST(list_amount AS DOUBLE) / CAST(tot AS DOUBLE) * revenue')} END AS part FROM f2),
  f4 AS (SELECT *, greatest(list_amount - part, 0) AS disc2, CASE WHEN st = '취소' THEN -abs(part) ELSE part END AS tp, bool_or(contains(nm, '홀_')) OVER (PARTITION BY oid) AS hall FROM f3),
  f5 AS (SELECT *, CASE WHEN hall THEN '홀' WHEN platform IN ('AUTOMOBILE', 'MACHINERY') THEN 'GARAGE' ELSE platform END AS pf, CASE WHEN hall THEN '홀_테이블' WHEN pack THEN '배달_포장' ELSE '배달' END AS ot FROM f4
    WHERE NOT (nm IN ('배달비', 'ITEM 7') OR (nm = '토핑추가' AND store IN ('NATION_1', 'NATION_2')))),
  f6 AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY unit_price DESC, item_seq) AS rk, first_value(nm) OVER (PARTITION BY oid ORDER BY unit_price DESC, item_seq) AS mn FROM f5)"""


def feed(t):
    from tillbook.catalog.c07_reconcile import blacklist

    k = F.col("o_orderkey")
    # Some orders come under the store's old name, some with the brand before it.
    old = F.regexp_replace("store", "^NATION_", "TOWN_")
    given = F.when(k % 9 == 0, old).when(k % 9 == 1, F.concat(F.lit("Grill "), "store")).when(k % 9 == 2, F.concat(F.lit(" Grill "), old)).otherwise(F.col("store"))
    aliases = t.stores.select(F.concat(F.lit("Grill "), old).alias("old"), F.col("store").alias("new"))
    orders = t.heads.select(
        "sale_date", given.alias("store"), F.col("region").alias("brand"), F.concat(F.lit("00"), "order_id").alias("order_code"),
        F.when(k % 6 == 0, " ").otherwise(F.concat(F.lit("X"), "order_id")).alias("external_no"), F.col("platform").alias("path"),
        F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("배달").alias("order_kind"), F.col("source").alias("status"),
        F.col("order_amount").alias("total"), ((k % 3) * 1000).alias("fee"), F.when(k % 10 == 0, F.col("order_amount")).otherwise(0).alias("discount"),
        (F.col("order_amount") - 500).alias("paid"), F.when(k % 7 == 0, "own rider area").otherwise("").alias("address"), F.lit("HEAD").alias("menu"), "order_time",
    )
    name = F.when(F.col("l_partkey") % 50 == 13, "홀_ITEM").otherwise(item_name())
    items = t.raw_lines.select(
        T("l_orderkey").alias("order_code"), F.when(name != "", F.concat(F.lit("'+ "), name)).otherwise("").alias("item_name"), "qty", "unit_price",
        F.col("list_amount").alias("amount"), "l_orderkey", *LINE_ORDER,
    )
    rules = dict(flat_pack=["AUTOMOBILE"], paid_less_fee=["BUILDING"], total_less_fee=["FURNITURE"], own_rider=["HOUSEHOLD"], rider_mark="own rider")
    return u.delivery_feed(
        orders, items, t.stores, blacklist(t), ["l_orderkey", *LINE_ORDER], {"AUTOMOBILE": "GARAGE", "MACHINERY": "GARAGE"}, ["F", "O"], rules,
        aliases=aliases, brands=["Grill"],
    )


FEED_COLS = f"""CAST(sale_date AS VARCHAR) AS sale_date, ym, 'feed' AS source, region AS brand, store, region, manager, CAST(open_date AS VARCHAR) AS open_date, pf AS platform, ot AS order_type, oid AS order_id, order_time,
  mn AS menu_name, item_seq, md5(nm) AS item_id, nm AS item_name, qty, unit_price, tp AS total_price, disc2 AS discount_amount, st AS sale_type,
  md5(concat_ws('|', CAST(sale_date AS VARCHAR), 'feed', store, pf, oid, CAST(item_seq AS VARCHAR))) AS _pk, CASE WHEN rk > 1 THEN 0 WHEN st = '취소' THEN -1 ELSE 1 END AS order_cnt"""


@query("unify_delivery_feed", f"WITH {R2} SELECT {FEED_COLS} FROM f6")
def unify_delivery_feed(t):
    return feed(t)[0]


@query("recalculate_order_fields", f"""WITH {R2}, f7 AS (SELECT * EXCLUDE (rk, mn), row_number() OVER (PARTITION BY oid ORDER BY unit_price DESC, item_seq) AS rk, first_value(nm) OVER (PARTITION BY oid ORDER BY unit_price DESC, item_seq) AS mn
  FROM f6 WHERE nm <> '토핑추가') SELECT {FEED_COLS} FROM f7""")
def recalculate_order_fields(t):
    lines, _, hot = feed(t)
    return u.recalculate_order_fields(lines.where(F.col("item_name") != "토핑추가"), hot=hot)


# -- union POS ----------------------------------------------------------------

R3 = LINES + ", " + MASTER + f""", u0 AS (SELECT l.*, CASE WHEN source = 'P' THEN '취소' ELSE '정상' END AS stp, CASE l_partkey % 13 WHEN 0 THEN '┗ (소)' WHEN 1 THEN '┗ 낙지' ELSE {NAME} END AS raw_name,
    CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE net_amount END AS up, (o_orderkey % 5) || '_' || order_id || '_' || CAST(sale_date AS VARCHAR) || ' ' || order_time AS oid FROM lines l WHERE o_orderkey % 8 <> 0),
  u1 AS (SELECT u0.*, bool_or(l_partkey % 17 = 0) OVER (PARTITION BY oid) AS pack, row_number() OVER (PARTITION BY oid ORDER BY {LINE_SEQ}) AS item_seq, COALESCE(m.main, false) AS main,
    CASE raw_name WHEN '┗ (소)' THEN '' WHEN '┗ 낙지' THEN '낙지' ELSE raw_name END AS item_name FROM u0 LEFT JOIN mst m ON m.code = u0.item_id)
  {segments_sql('u1', 'main', 'up', 'true', 'oid').replace("WHEN fee THEN 1 ELSE 0 END", "WHEN fee OR pr = 0 THEN 1 ELSE 0 END")},
  u2 AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY CASE WHEN item_name <> '' THEN up ELSE 0 END DESC, item_seq) AS rk FROM seg)"""


@query("unify_union_pos", f"""WITH {R3} SELECT CAST(sale_date AS VARCHAR) AS sale_date, ym, 'union' AS source, '' AS brand, store, region, manager, CAST(open_date AS VARCHAR) AS open_date, '홀' AS platform,
  CASE WHEN pack THEN '홀_포장' ELSE '홀_테이블' END AS order_type, oid AS order_id, order_time, COALESCE(menu, '') AS menu_name, item_seq, item_id, item_name, qty, up AS unit_price, CASE WHEN stp = '취소' THEN -up ELSE up END AS total_price,
  0 AS discount_amount, stp AS sale_type, md5(concat_ws('|', CAST(sale_date AS VARCHAR), 'union', store, '홀', oid, CAST(item_seq AS VARCHAR))) AS _pk, CASE WHEN rk > 1 THEN 0 WHEN stp = '취소' THEN -1 ELSE 1 END AS order_cnt
  FROM u2 WHERE NOT (item_name = '' AND up = 0)""")
def unify_union_pos(t):
    k = F.col("o_orderkey")
    sold = F.concat_ws(" ", F.date_format("sale_date", "yyyy-MM-dd"), "order_time")
    heads = t.heads.select(
        "sale_date", "store", F.concat(F.lit("0"), "order_id").alias("receipt_no"), F.concat(F.lit("0"), k % 5).alias("pos_no"), sold.alias("sold_at"),
        F.when(k % 8 == 0, "전취").when(F.col("source") == "P", "반품").otherwise("판매").alias("sale_type"),
    )
    lk = F.col("l_partkey")
    items = t.lines.select(
        "store", F.concat(F.lit("00"), "order_id").alias("receipt_no"), sold.alias("sold_at"), F.concat(F.lit("00"), T("l_partkey")).alias("item_id"),
        F.when(lk % 13 == 0, "┗ (소)").when(lk % 13 == 1, "┗ 낙지").otherwise(item_name()).alias("item_name"),
        F.when(F.col("l_linenumber") % 3 == 0, "").otherwise("판매").alias("item_sale_type"), F.format_number("net_amount", 0).alias("amount"), "qty",
        F.when(lk % 17 == 0, "포장류").otherwise("").alias("category"), *LINE_ORDER,
    )
    return u.unify_union_pos(heads, items, t.stores, master_full(t), LINE_ORDER)


# -- single-store POS ---------------------------------------------------------

R4 = LINES + f""", e0 AS (SELECT l.*, p.p_name AS nm, CASE WHEN source = 'P' THEN '취소' ELSE '정상' END AS st, order_id || '_' || CAST(sale_date AS VARCHAR) || '_' || order_time AS oid
    FROM lines l JOIN part p ON p.p_partkey = l.l_partkey),
  cd AS (SELECT p_name AS nm, min(CAST(p_partkey AS VARCHAR)) AS code FROM part WHERE p_type <> 'PROMO' GROUP BY p_name),
  e1 AS (SELECT e0.*, COALESCE(cd.code, md5(e0.nm)) AS code, row_number() OVER (PARTITION BY oid ORDER BY {LINE_SEQ}) AS item_seq FROM e0 LEFT JOIN cd USING (nm)),
  e2 AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY net_amount DESC, item_seq) AS rk, first_value(nm) OVER (PARTITION BY oid ORDER BY net_amount DESC, item_seq) AS mn FROM e1)"""


@query("unify_easy_pos", f"""WITH {R4} SELECT CAST(e2.sale_date AS VARCHAR) AS sale_date, ym, 'easy' AS source, '' AS brand, s.store, s.region, s.manager, CAST(s.open_date AS VARCHAR) AS open_date, '홀' AS platform,
  CASE WHEN order_type IN ('1-URGENT', '2-HIGH') THEN '홀_포장' ELSE '홀_테이블' END AS order_type, oid AS order_id, order_time, mn AS menu_name, item_seq, code AS item_id, nm AS item_name, qty, net_amount AS unit_price,
  CASE WHEN st = '취소' THEN -net_amount ELSE net_amount END AS total_price, 0 AS discount_amount, st AS sale_type, md5(concat_ws('|', CAST(e2.sale_date AS VARCHAR), 'easy', 'NATION_9', '홀', oid, CAST(item_seq AS VARCHAR))) AS _pk,
  CASE WHEN rk > 1 THEN 0 WHEN st = '취소' THEN -1 ELSE 1 END AS order_cnt FROM e2, stores s WHERE s.store = 'NATION_9'""")
def unify_easy_pos(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("nm"))
    raw = t.lines.join(p, "l_partkey").select(
        "sale_date", F.col("order_id").alias("receipt_no"), F.when(F.col("l_linenumber") % 2 == 0, F.col("nm")).alias("item_name"), F.when(F.col("l_linenumber") % 2 == 1, F.col("nm")).alias("item_name "),
        F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("매장").alias("receipt_type"), "order_time",
        F.when(F.col("source") == "P", "반품").otherwise("매출").alias("sale_type"), F.format_number("net_amount", 0).alias("line_amount"), "qty", *LINE_ORDER,
    )
    return u.unify_easy_pos(raw, t.stores, t.products.where(F.col("label") != "PROMO"), LINE_ORDER, "NATION_9")


# -- delivery platforms -------------------------------------------------------

R5 = LINES + f""", b0 AS (SELECT l.*, {NAME} AS nm, 'ITEM ' || (l_suppkey % 50) AS mn, row_number() OVER (PARTITION BY order_id ORDER BY {LINE_SEQ}) AS item_seq,
    CASE WHEN l_linenumber <= 2 THEN order_amount ELSE 0 END AS paid, unit_price * qty AS it FROM lines l WHERE source <> 'P'),
  b1 AS (SELECT *, COALESCE(first_value(NULLIF(paid, 0) IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY item_seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS amt,
    sum(it) OVER (PARTITION BY order_id) AS tot, row_number() OVER (PARTITION BY order_id ORDER BY CASE WHEN nm = mn THEN 0 ELSE 1 END, unit_price DESC, item_seq) AS rk FROM b0),
  b2 AS (SELECT *, CASE WHEN tot = 0 THEN 0 WHEN tot = amt THEN it ELSE {rint('CAST(it AS DOUBLE) / CAST(tot AS DOUBLE) * amt')} END AS tp FROM b1)"""


def korean_stamp():
    h = F.substring("order_time", 1, 2).cast("int")
    return F.concat(
        F.date_format("sale_date", "yyyy. MM. dd. "), F.lit("(월) "), F.when(h >= 12, "오후 ").otherwise("오전 "),
        F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.substring("order_time", 3, 6),
    )


def platform_sql(src, source, name, extra_time="order_time"):
    return f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, ym, '{source}' AS source, region AS brand, store, region, manager, CAST(open_date AS VARCHAR) AS open_date, '{name}' AS platform,
  CASE WHEN order_type IN ('1-URGENT', '2-HIGH') THEN '배달_포장' ELSE '배달' END AS order_type, order_id, order_time, mn AS menu_name, item_seq, CASE WHEN nm <> '' THEN md5(nm) ELSE '' END AS item_id, nm AS item_name, qty, up AS unit_price, tp AS total_price,
  0 AS discount_amount, '정상' AS sale_type, md5(concat_ws('|', CAST(sale_date AS VARCHAR), '{source}', store, '{name}', order_id, CAST(item_seq AS VARCHAR))) AS _pk, CASE WHEN rk > 1 THEN 0 ELSE 1 END AS order_cnt FROM {src}"""


@query("unify_platform_a", f"WITH {R5}, b3 AS (SELECT *, unit_price AS up FROM b2) {platform_sql('b3', 'platform_a', 'A')}")
def unify_platform_a(t):
    raw = t.lines.select(
        "order_id", F.when(F.col("source") == "P", "주문취소").otherwise("배달완료").alias("status"), korean_stamp().alias("ordered_at"), "store", F.col("region").alias("brand"),
        F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("배달").alias("receive"),
        F.concat(F.lit("ITEM "), F.col("l_suppkey") % 50, F.lit(" 외 2건")).alias("summary"), item_name().alias("option_name"), T("qty").alias("qty"),
        F.format_number("unit_price", 0).alias("option_price"), F.when(F.col("l_linenumber") <= 2, F.format_number("order_amount", 0)).otherwise("").alias("paid"), *LINE_ORDER,
    )
    return u.unify_platform_a(raw, t.stores, LINE_ORDER, "배달완료")


R6 = LINES + f""", c0 AS (SELECT l.*, {NAME} AS nm, 'ITEM ' || (l_suppkey % 50) AS mn, row_number() OVER (PARTITION BY order_id ORDER BY {LINE_SEQ}) AS item_seq, CASE WHEN l_linenumber % 3 <> 0 THEN unit_price END AS mp,
    CASE WHEN o_orderkey % 2 = 0 AND l_linenumber % 2 = 0 THEN order_amount - 100 END AS sales, bool_or(o_orderkey % 9 = 0 AND l_linenumber = 2) OVER (PARTITION BY order_id) AS off FROM lines l),
  c1 AS (SELECT *, COALESCE(first_value(CASE WHEN sales > 0 THEN sales END IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY item_seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), order_amount) AS oa,
    COALESCE(CASE WHEN nm = '토핑추가' THEN 500 WHEN starts_with(nm, 'ITEM ') AND l_partkey % 50 < 20 THEN (l_partkey % 50) * 10 END, 0) AS op FROM c0 WHERE NOT off),
  c2 AS (SELECT *, CAST(sum(CASE WHEN mp IS NOT NULL OR item_seq = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY item_seq) AS BIGINT) - 1 AS menu_group FROM c1)
  {remainder_sql('c2', 'order_id', 'oa', 'mp', 'qty', 'op')},
  c3 AS (SELECT *, part AS tp, part AS up, row_number() OVER (PARTITION BY order_id ORDER BY CASE WHEN nm = mn THEN 0 ELSE 1 END, part DESC, item_seq) AS rk FROM alloc)"""


@query("unify_platform_b", f"WITH {R6} {platform_sql('c3', 'platform_b', 'B')}")
def unify_platform_b(t):
    k, ln = F.col("o_orderkey"), F.col("l_linenumber")
    raw = t.lines.select(
        "order_id", F.concat(F.date_format("sale_date", "yyyy.M.d "), F.substring("order_time", 1, 5)).alias("ordered_at"), "store", F.col("region").alias("brand"),
        F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("배달").alias("delivery_type"), F.concat(F.lit("ITEM "), F.col("l_suppkey") % 50).alias("menu_name"),
        item_name().alias("menu_options"), F.col("qty").alias("menu_qty"), F.when(ln % 3 != 0, F.col("unit_price")).alias("menu_price"), F.col("order_amount").alias("total"),
        F.when((k % 2 == 0) & (ln % 2 == 0), F.col("order_amount") - 100).alias("sales"), F.when((k % 9 == 0) & (ln == 2), "Y").otherwise("N").alias("cancelled"), F.lit(1).alias("collected_at"), *LINE_ORDER,
    )
    again = raw.where(F.col("l_returnflag") != "N").withColumn("collected_at", F.lit(2))
    lk = F.col("l_partkey")
    price = F.when(item_name() == "토핑추가", 500).when(item_name().startswith("ITEM ") & (lk % 50 < 20), (lk % 50) * 10)
    prices = t.table("part").select(F.col("p_partkey").alias("l_partkey")).select(item_name().alias("item_name"), price.cast("bigint").alias("option_price"))
    prices = prices.where(F.col("option_price").isNotNull()).distinct()
    dedup = {"order_id": False, "l_partkey": False, "l_suppkey": False, "l_linenumber": False, "menu_qty": True, "l_extendedprice": True}
    return u.unify_platform_b(raw.unionByName(again), t.stores, prices, LINE_ORDER, dedup)


# -- totals, look-back, extract, sheet ----------------------------------------

R7 = HEADS + f""", t0 AS (SELECT sale_date, ym, region AS brand, store, region, manager, open_date, CASE WHEN platform IN ('AUTOMOBILE', 'MACHINERY') THEN 'GARAGE' ELSE platform END AS platform, order_amount FROM heads
    WHERE source <> 'P' AND region <> 'ASIA' AND order_amount > 0), t1 AS (SELECT sale_date, ym, brand, store, region, manager, open_date, platform, {big('sum(order_amount)')} AS tp FROM t0 GROUP BY ALL)"""
TOTAL_COLS = f"""CAST(sale_date AS VARCHAR) AS sale_date, ym, 'report' AS source, brand, store, region, manager, CAST(open_date AS VARCHAR) AS open_date, platform, CASE platform WHEN 'BUILDING' THEN '홀_테이블' ELSE '배달' END AS order_type,
  store || '_' || platform AS order_id, '00:00:00' AS order_time, '' AS menu_name, 1 AS item_seq, '' AS item_id, '' AS item_name, 1 AS qty, tp AS unit_price, tp AS total_price, 0 AS discount_amount, '정상' AS sale_type,
  md5(concat_ws('|', CAST(sale_date AS VARCHAR), 'report', store, platform, store || '_' || platform, '1')) AS _pk, 1 AS order_cnt"""


def report_totals(t, heads):
    totals = heads.where(F.col("source") != "P").select("sale_date", F.col("region").alias("brand"), "store", "platform", F.col("order_amount").alias("price"))
    covered = t.stores.where(F.col("region") == "ASIA").select("store")
    return u.unify_report_totals(totals, covered, t.stores, {"AUTOMOBILE": "GARAGE", "MACHINERY": "GARAGE"}, {"BUILDING": "홀_테이블"})


@query("unify_report_totals", f"WITH {R7} SELECT {TOTAL_COLS} FROM t1")
def unify_report_totals(t):
    return report_totals(t, t.heads)


@query("lookback_backfill", f"""WITH {R7}, have AS (SELECT DISTINCT sale_date FROM heads WHERE source = 'F'), todo AS (SELECT DISTINCT sale_date FROM heads WHERE sale_date > DATE '{AS_OF}' - INTERVAL 30 DAY
    UNION SELECT DISTINCT sale_date FROM heads WHERE sale_date NOT IN (SELECT sale_date FROM have)) SELECT {TOTAL_COLS} FROM t1 WHERE sale_date IN (SELECT sale_date FROM todo)""")
def lookback_backfill(t):
    days = u.dates_to_build(t.heads.select("sale_date"), t.heads.where(F.col("source") == "F").select("sale_date"), AS_OF, 30)
    return report_totals(t, t.heads.join(days, "sale_date", "left_semi"))


@query("platform_orders_extract", f"""WITH {LINES}, x AS (SELECT *, {NAME} AS nm, row_number() OVER (PARTITION BY order_id ORDER BY {LINE_SEQ}) AS n, max(l_discount) OVER (PARTITION BY order_id) > 0.08 AS cp FROM lines)
  SELECT order_id, order_id || '_' || n AS sub_order_id, CAST(sale_date AS VARCHAR) AS order_daily, order_time, CASE WHEN nm = '' THEN 'ITEM 1' WHEN nm = 'ITEM 1' THEN '' ELSE nm END AS option, manager, CASE WHEN cp THEN 'Y' ELSE 'N' END AS coupon_yn FROM x""")
def platform_orders_extract(t):
    a = F.col("platform").isin("AUTOMOBILE", "BUILDING")
    short = F.concat(F.date_format("sale_date", "yyyy.M.d "), F.substring("order_time", 1, 5))
    cols = lambda stamp: [
        "order_id", "platform", stamp.alias("ordered_at"), F.concat(F.lit("SHOP "), F.replace("region", F.lit(" "), F.lit("_")), F.lit(" "), "store").alias("store_name"),
        F.lit("ITEM 1").alias("summary"), item_name().alias("option_name"), F.when(F.col("l_discount") > 0.08, 1).otherwise(0).alias("coupon"), *LINE_ORDER,
    ]
    stores = t.stores.select(F.concat(F.replace("region", F.lit(" "), F.lit("_")), F.lit(" "), "store").alias("store_name"), "manager")
    out = u.platform_orders_extract([t.lines.where(a).select(*cols(korean_stamp())), t.lines.where(~a).select(*cols(short))], stores, LINE_ORDER)
    return out.select("order_id", "sub_order_id", "order_daily", "order_time", "option", "manager", "coupon_yn")


NATIONS = [f"NATION_{i}" for i in range(25)]


@query("report_sheet_to_long", f"WITH {HEADS} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store, platform, {big('sum(order_amount)')} AS price, count(*) AS receipts FROM heads GROUP BY sale_date, store, platform")
def report_sheet_to_long(t):
    sheet = t.heads.groupBy("sale_date", F.concat(F.lit(" "), "platform").alias("channel")).pivot("store", NATIONS).agg(
        F.format_number(F.sum("order_amount"), 0).alias("p"), F.count(F.lit(1)).cast("string").alias("n")
    )
    total = sheet.withColumn("channel", F.lit("합계"))
    return u.report_sheet_to_long(sheet.unionByName(total), [(s, f"{s}_p", f"{s}_n") for s in NATIONS])


# -- master tables ------------------------------------------------------------

MST = PRODUCTS + """, base AS (SELECT CASE WHEN part_key % 2 = 0 THEN 'a' ELSE 'b' END AS source, code, name, label, brand, list_price, size, part_key FROM products),
  old AS (SELECT source, code, name, list_price, CASE WHEN size % 5 = 0 THEN '' ELSE label END AS label, CASE WHEN size % 3 = 0 THEN 'Y' ELSE 'N' END AS review_needed, CASE WHEN size % 7 = 0 THEN 'Y' ELSE 'N' END AS exclude_check, CASE WHEN size % 2 = 0 THEN 'Y' ELSE '' END AS approve,
    DATE '2001-01-01' AS updated_at, 1 AS version FROM base WHERE brand <> 'Brand#5'),
  inc AS (SELECT source, code, name, CASE WHEN brand = 'Brand#7' THEN list_price + 100 ELSE list_price END AS list_price FROM base),
  chg AS (SELECT i.source, i.code, i.name, i.list_price, CASE WHEN o.label <> '' AND o.review_needed <> 'Y' THEN o.label WHEN contains(i.name, 'ring') THEN 'RING' ELSE 'OTHER' END AS label,
    CASE WHEN o.label <> '' AND o.review_needed <> 'Y' THEN 'N' ELSE 'Y' END AS review_needed, COALESCE(o.exclude_check, 'N') AS exclude_check, '' AS approve, DATE '2001-08-01' AS updated_at, COALESCE(o.version, 0) + 1 AS version
    FROM inc i LEFT JOIN old o USING (source, code) WHERE o.code IS NULL OR o.name <> i.name OR o.list_price <> i.list_price),
  upd AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY source, code ORDER BY updated_at DESC, version DESC) = 1 THEN 'Y' ELSE 'N' END AS is_latest FROM (SELECT * FROM old UNION ALL BY NAME SELECT * FROM chg))"""


def product_master(t):
    src = F.when(F.col("part_key") % 2 == 0, "a").otherwise("b")
    p = t.products.withColumn("source", src)
    yn = lambda n: F.when(F.col("size") % n == 0, "Y").otherwise("N")
    old = p.where(F.col("brand") != "Brand#5").select(
        "source", "code", "name", "list_price", F.when(F.col("size") % 5 == 0, "").otherwise(F.col("label")).alias("label"), yn(3).alias("review_needed"), yn(7).alias("exclude_check"),
        F.when(F.col("size") % 2 == 0, "Y").otherwise("").alias("approve"), F.lit("2001-01-01").cast("date").alias("updated_at"), F.lit(1).alias("version"),
    )
    inc = p.select("source", "code", "name", F.when(F.col("brand") == "Brand#7", F.col("list_price") + 100).otherwise(F.col("list_price")).alias("list_price"))
    label = F.when(F.col("name").contains("ring"), "RING").otherwise("OTHER")
    return ms.product_master_update(old, inc, ["name", "list_price"], label, "2001-08-01")


@query("product_master_update", f"WITH {MST} SELECT * REPLACE (CAST(updated_at AS VARCHAR) AS updated_at) FROM upd")
def product_master_update(t):
    return product_master(t)


@query("apply_review_approvals", f"""WITH {MST}, ch AS (SELECT * FROM upd WHERE is_latest = 'Y' AND review_needed = 'Y' AND approve = 'Y'),
  al AS (SELECT u.* EXCLUDE (is_latest) REPLACE (CASE WHEN EXISTS (SELECT 1 FROM ch WHERE ch.source = u.source AND ch.code = u.code) THEN '' ELSE u.approve END AS approve) FROM upd u
    UNION ALL BY NAME SELECT * EXCLUDE (is_latest) REPLACE ('N' AS review_needed, '' AS approve, DATE '2001-08-02' AS updated_at, version + 1 AS version) FROM ch)
  SELECT * REPLACE (CAST(updated_at AS VARCHAR) AS updated_at), CASE WHEN row_number() OVER (PARTITION BY source, code ORDER BY updated_at DESC, version DESC) = 1 THEN 'Y' ELSE 'N' END AS is_latest FROM al""")
def apply_review_approvals(t):
    return ms.apply_review_approvals(product_master(t), "2001-08-02")


UNSEEN = MST + """, ln AS (SELECT CAST(l_partkey AS VARCHAR) AS code, p_name || ' new' AS name, CAST(round(l_extendedprice / l_quantity) AS BIGINT) AS list_price, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 4 = 0),
  un AS (SELECT 'a' AS source, code, name, list_price, '기타' AS label, 'Y' AS review_needed, 'N' AS exclude_check, '' AS approve, DATE '2001-09-01' AS updated_at, 1 AS version FROM ln
    WHERE code NOT IN (SELECT code FROM upd WHERE source = 'a' AND brand_5 IS NULL) QUALIFY row_number() OVER (PARTITION BY code ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) = 1)"""
UNSEEN = UNSEEN.replace(" AND brand_5 IS NULL", " AND CAST(code AS BIGINT) % 8 <> 0")


def with_unseen(t):
    """The master without some products of a source, and the lines that sell them."""
    gone = (F.col("source") == "a") & (F.col("code").cast("long") % 8 == 0)
    lines = t.raw_lines.join(t.products.select(F.col("part_key").alias("l_partkey"), F.col("name").alias("_n")), "l_partkey").where("l_partkey % 4 = 0")
    lines = lines.select(T("l_partkey").alias("code"), F.concat("_n", F.lit(" new")).alias("name"), F.col("unit_price").alias("list_price"), "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return ms.append_unseen_codes(product_master(t).where(~gone), lines, "a", order, "2001-09-01")


@query("append_unseen_codes", f"""WITH {UNSEEN} SELECT * EXCLUDE (is_latest) REPLACE (CAST(updated_at AS VARCHAR) AS updated_at) FROM upd WHERE NOT (source = 'a' AND CAST(code AS BIGINT) % 8 = 0)
  UNION ALL BY NAME SELECT * REPLACE (CAST(updated_at AS VARCHAR) AS updated_at) FROM un""")
def append_unseen_codes(t):
    return with_unseen(t).drop("is_latest")


@query("finalise_pending", f"""WITH {UNSEEN}, al AS (SELECT * EXCLUDE (is_latest) FROM upd WHERE NOT (source = 'a' AND CAST(code AS BIGINT) % 8 = 0) UNION ALL BY NAME SELECT * FROM un),
  nw AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY source, code ORDER BY updated_at DESC, version DESC) = 1),
  pe AS (SELECT * FROM nw WHERE source = 'a' AND review_needed = 'Y'), ex AS (SELECT DISTINCT name, label FROM nw WHERE review_needed <> 'Y' AND label <> ''),
  ti AS (SELECT DISTINCT name, unnest(string_split(lower(name), ' ')) AS w FROM pe), te AS (SELECT DISTINCT name, unnest(string_split(lower(name), ' ')) AS w FROM ex),
  ni AS (SELECT name, count(*) AS n FROM ti GROUP BY name), ne AS (SELECT name, count(*) AS n FROM te GROUP BY name),
  sh AS (SELECT ti.name AS i, te.name AS e, count(*) AS s FROM ti JOIN te USING (w) GROUP BY ALL),
  sc AS (SELECT sh.i, ex.label, max(CASE WHEN sh.i = sh.e THEN 100 ELSE 100 * s // greatest(ni.n, ne.n) END) AS score FROM sh JOIN ni ON ni.name = sh.i JOIN ne ON ne.name = sh.e JOIN ex ON ex.name = sh.e GROUP BY sh.i, ex.label),
  be AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, label) = 1),
  fi AS (SELECT pe.* REPLACE (CASE WHEN be.score >= 70 THEN be.label WHEN contains(pe.name, 'ring') THEN 'RING' ELSE 'OTHER' END AS label, 'N' AS review_needed, '' AS approve, DATE '2001-10-01' AS updated_at, version + 1 AS version) FROM pe LEFT JOIN be ON be.i = pe.name),
  o AS (SELECT * FROM al UNION ALL BY NAME SELECT * FROM fi)
  SELECT * REPLACE (CAST(updated_at AS VARCHAR) AS updated_at), CASE WHEN row_number() OVER (PARTITION BY source, code ORDER BY updated_at DESC, version DESC) = 1 THEN 'Y' ELSE 'N' END AS is_latest FROM o""")
def finalise_pending(t):
    return ms.finalise_pending(with_unseen(t), "a", F.when(F.col("name").contains("ring"), "RING").otherwise("OTHER"), "2001-10-01")


ORDER = ("HOUSEHOLD", "BUILDING", "AUTOMOBILE")


@query("policy_consolidate", f"""WITH {HEADS}, p AS (SELECT platform, CAST(sale_date AS VARCHAR) AS policy_date, 'doc ' || order_id AS title FROM heads),
  l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY platform ORDER BY policy_date DESC, title) = 1), pr AS (SELECT platform, max(CAST(sale_date AS VARCHAR)) AS prev FROM heads WHERE source = 'F' GROUP BY platform)
  SELECT l.platform, l.policy_date, l.title, CASE l.platform WHEN 'HOUSEHOLD' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'AUTOMOBILE' THEN 3 ELSE 999 END AS platform_order, CASE WHEN pr.prev = l.policy_date THEN 'N' ELSE 'Y' END AS is_new FROM l LEFT JOIN pr USING (platform)""")
def policy_consolidate(t):
    doc = lambda df: df.select("platform", F.date_format("sale_date", "yyyy-MM-dd").alias("policy_date"), F.concat(F.lit("doc "), "order_id").alias("title"))
    sources = [doc(t.heads.where(F.col("source") == s)) for s in ("F", "O", "P")]
    prev = t.heads.where(F.col("source") == "F").groupBy("platform").agg(F.date_format(F.max("sale_date"), "yyyy-MM-dd").alias("policy_date"))
    return ms.policy_consolidate(sources, prev, ORDER)


@query("visit_log_merge", f"""WITH {EVENTS}, mm AS (SELECT 'V' || event_id AS visit, CASE WHEN k % 2 = 0 THEN store ELSE ' ' END AS place, event_type AS note FROM ev WHERE event_type <> 'view'),
  nn AS (SELECT 'V' || event_id AS visit, store AS place, 'new ' || k AS note FROM ev WHERE event_type <> 'click')
  SELECT visit, COALESCE(NULLIF(trim(mm.place), ''), nn.place) AS place, COALESCE(mm.note, nn.note) AS note FROM mm FULL JOIN nn USING (visit)""")
def visit_log_merge(t):
    visit = F.concat(F.lit("V"), T("event_id")).alias("visit")
    old = t.events.where(F.col("event_type") != "view").select(visit, F.when(F.col("k") % 2 == 0, F.col("store")).otherwise(" ").alias("place"), F.col("event_type").alias("note"))
    new = t.events.where(F.col("event_type") != "click").select(visit, F.col("store").alias("place"), F.concat(F.lit("new "), T("k")).alias("note"))
    return ms.visit_log_merge(old, new, "visit", ["place", "note"])
