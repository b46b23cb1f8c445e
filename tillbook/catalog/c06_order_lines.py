"""Line-level windows and allocations inside an order."""

from pyspark.sql import functions as F

from tillbook.catalog.base import LINE_SEQ, LINES, PRODUCTS, big, query, ratio, rint, rnd
from tillbook.operators import order_lines as o
from tillbook.operators.core import hot_keys
from tillbook.sources.fixtures import LINE_ORDER

K = ["order_id"]
NAME = "CASE l_partkey % 11 WHEN 0 THEN '배달비' WHEN 1 THEN '토핑추가' WHEN 2 THEN '' ELSE 'ITEM ' || CAST(l_partkey % 50 AS VARCHAR) END"
OL = LINES + f""", ol AS (SELECT * REPLACE (CASE WHEN source = 'P' THEN '취소' ELSE '정상' END AS sale_type), {NAME} AS item_name,
  row_number() OVER (PARTITION BY order_id ORDER BY {LINE_SEQ}) AS item_seq FROM lines)"""
W = "OVER (PARTITION BY order_id)"
WS = "OVER (PARTITION BY order_id ORDER BY item_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def item_name():
    k = F.col("l_partkey") % 11
    return (
        F.when(k == 0, "배달비").when(k == 1, "토핑추가").when(k == 2, "")
        .otherwise(F.concat(F.lit("ITEM "), F.col("l_partkey") % 50))
    )


def hot_orders(t):
    """Order keys with too many lines for one task, counted on the key column of the raw table."""
    return hot_keys(t.table("lineitem").select(F.col("l_orderkey").cast("string").alias("order_id")), K)


def order_lines(t, hot=None):
    rows = t.lines.withColumn("item_name", item_name()).withColumn(
        "sale_type", F.when(F.col("source") == "P", "취소").otherwise("정상")
    )
    return o.item_seq(rows, K, LINE_ORDER, hot=hot)


@query("item_seq", f"WITH {OL} SELECT order_id, l_partkey, l_suppkey, item_seq FROM ol")
def item_seq(t):
    return order_lines(t, hot_orders(t)).select("order_id", "l_partkey", "l_suppkey", "item_seq")


@query("representative_row", f"""WITH {OL}, r AS (SELECT order_id, item_seq AS rs, item_name AS rn FROM ol QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY unit_price DESC, item_seq) = 1),
  r2 AS (SELECT order_id, item_seq AS rs2, item_name AS rn2 FROM ol QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY CASE WHEN item_name LIKE 'ITEM 1%' THEN 0 ELSE 1 END, unit_price DESC, item_seq) = 1)
  SELECT order_id, item_seq, rn AS menu_name, CASE WHEN item_seq <> rs THEN 0 WHEN sale_type = '취소' THEN -1 ELSE 1 END AS order_cnt,
    rn2 AS matched_name, CASE WHEN item_seq <> rs2 THEN 0 WHEN sale_type = '취소' THEN 0 ELSE 1 END AS matched_cnt
  FROM ol JOIN r USING (order_id) JOIN r2 USING (order_id)""")
def representative_row(t):
    hot = hot_orders(t)
    rows = order_lines(t, hot).select("order_id", "item_seq", "item_name", "unit_price", "sale_type")
    a = o.representative_row(rows, K, "unit_price", hot=hot).withColumnsRenamed({"menu_name": "_m", "order_cnt": "_c"})
    b = o.representative_row(a, K, "unit_price", 0, F.col("item_name").startswith("ITEM 1"), hot=hot)
    return b.select(
        "order_id", "item_seq", F.col("_m").alias("menu_name"), F.col("_c").alias("order_cnt"),
        F.col("menu_name").alias("matched_name"), F.col("order_cnt").alias("matched_cnt"),
    )


@query("order_cnt_last_line", f"""WITH {OL} SELECT order_id, item_seq, CASE WHEN item_seq <> max(item_seq) {W} THEN 0 WHEN sale_type = '취소' THEN -1 ELSE 1 END AS order_cnt FROM ol""")
def order_cnt_last_line(t):
    hot = hot_orders(t)
    return o.order_cnt_last_line(order_lines(t, hot).select("order_id", "item_seq", "sale_type"), K, hot=hot).drop("sale_type")


def segments_sql(src, main, price, hall, keys="order_id"):
    """Independent window form of the main-item segments, ending in table seg."""
    w = f"OVER (PARTITION BY {keys})"
    ws = f"OVER (PARTITION BY {keys} ORDER BY item_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f""", g0 AS (SELECT *, NULLIF(trim(item_name), '') AS nm, COALESCE({price}, 0) AS pr, COALESCE({hall}, false) AS hall,
    regexp_matches(COALESCE(item_name, ''), '배달비|배달팁|포장비|쿠폰|할인|서비스|수수료') AS fee,
    regexp_matches(COALESCE(item_name, ''), '추가|옵션|토핑|사리|변경|선택|곱빼기|맵기') AS opt, COALESCE({main}, false) AS mn FROM {src}),
  g1 AS (SELECT *, bool_or(mn AND nm IS NOT NULL AND pr > 0) {w} AS has_main, max(pr) FILTER (nm IS NOT NULL) {w} AS mx,
    first_value(hall) OVER (PARTITION BY {keys} ORDER BY item_seq) AS oh,
    first_value(nm) OVER (PARTITION BY {keys} ORDER BY CASE WHEN nm IS NULL THEN 2 WHEN fee THEN 1 ELSE 0 END, pr DESC, item_seq) AS best FROM g0),
  g2 AS (SELECT *, CASE WHEN has_main THEN CASE WHEN mn AND nm IS NOT NULL AND pr > 0 THEN nm END
    WHEN NOT oh AND nm IS NOT NULL AND NOT fee AND NOT opt AND pr >= greatest(2000.0, mx * 0.25) THEN nm END AS st FROM g1),
  seg AS (SELECT *, COALESCE(last_value(st IGNORE NULLS) {ws}, first_value(st IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY item_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), best) AS menu FROM g2)"""


@query("main_item_segments", f"""WITH {OL} {segments_sql('ol', "l_partkey % 7 = 0 AND order_type <> '5-LOW'", 'unit_price', "order_type IN ('1-URGENT', '4-NOT SPECIFIED')")}
  SELECT order_id, item_seq, item_name, menu AS menu_name FROM seg""")
def main_item_segments(t):
    h = hot_orders(t)
    rows = order_lines(t, h).select("order_id", "item_seq", "item_name", "unit_price", "l_partkey", "order_type")
    main = (F.col("l_partkey") % 7 == 0) & (F.col("order_type") != "5-LOW")
    hall = F.col("order_type").isin("1-URGENT", "4-NOT SPECIFIED")
    return o.main_item_segments(rows, K, main, "unit_price", hall, hot=h).select("order_id", "item_seq", "item_name", "menu_name")


GRP = OL + f""", gp AS (SELECT *, CASE WHEN l_linenumber % 3 <> 0 THEN unit_price END AS menu_price FROM ol),
  gr AS (SELECT *, CAST(sum(CASE WHEN menu_price IS NOT NULL OR item_seq = 1 THEN 1 ELSE 0 END) {WS} AS BIGINT) - 1 AS menu_group FROM gp)"""


def grouped(t, hot):
    rows = order_lines(t, hot).withColumn("menu_price", F.when(F.col("l_linenumber") % 3 != 0, F.col("unit_price")))
    return o.menu_group_segments(rows, K, "menu_price", hot=hot)


@query("menu_group_segments", f"WITH {GRP} SELECT order_id, item_seq, menu_price, menu_group FROM gr")
def menu_group_segments(t):
    return grouped(t, hot_orders(t)).select("order_id", "item_seq", "menu_price", "menu_group")


@query("proportional_allocation", f"""WITH {OL}, s AS (SELECT *, sum(list_amount) {W} AS tot FROM ol)
  SELECT order_id, item_seq, list_amount, order_amount, CASE WHEN tot = 0 THEN 0 WHEN tot = order_amount THEN list_amount
    ELSE {rint('CAST(list_amount AS DOUBLE) / CAST(tot AS DOUBLE) * order_amount')} END AS part FROM s""")
def proportional_allocation(t):
    hot = hot_orders(t)
    rows = order_lines(t, hot).select("order_id", "item_seq", "list_amount", "order_amount")
    return o.proportional_allocation(rows, K, "list_amount", "order_amount", "part", hot=hot)


def remainder_sql(src, keys, amount, price, qty, opt):
    """Two-level split with window functions, ending in table alloc (column part)."""
    g = f"PARTITION BY {keys}, menu_group"
    return f""", a0 AS (SELECT *, first_value(item_seq) OVER ({g} ORDER BY CASE WHEN {price} IS NULL THEN 1 ELSE 0 END, item_seq) AS ms FROM {src}),
  a1 AS (SELECT {keys}, menu_group, max({amount}) AS amt, max(CASE WHEN item_seq = ms THEN CAST(COALESCE({price}, 0) AS DOUBLE) * CASE WHEN {qty} > 0 THEN {qty} ELSE 1 END END) AS w
    FROM a0 GROUP BY ALL),
  a2 AS (SELECT *, sum(w) OVER (PARTITION BY {keys}) AS tw, max(menu_group) OVER (PARTITION BY {keys}) AS lg FROM a1),
  a3 AS (SELECT *, CASE WHEN menu_group = lg OR tw <= 0 THEN 0 ELSE {rint('amt * w / tw')} END AS r FROM a2),
  a4 AS (SELECT *, CASE WHEN menu_group = lg THEN amt - sum(r) OVER (PARTITION BY {keys}) ELSE r END AS ga FROM a3),
  a5 AS (SELECT a0.*, CAST(a4.ga AS BIGINT) AS ga, CASE WHEN item_seq <> ms AND {opt} > 0 THEN {opt} END AS paid FROM a0 JOIN a4 USING ({keys}, menu_group)),
  a6 AS (SELECT *, sum(paid) OVER ({g}) AS pt, max(CASE WHEN paid IS NOT NULL THEN item_seq END) OVER ({g}) AS lo FROM a5),
  a7 AS (SELECT *, CASE WHEN paid IS NOT NULL AND item_seq <> lo THEN {rint('ga * paid / pt')} END AS pp FROM a6),
  alloc AS (SELECT *, CAST(CASE WHEN pp IS NOT NULL THEN pp WHEN item_seq = lo THEN ga - COALESCE(sum(pp) OVER ({g}), 0) WHEN item_seq = ms AND lo IS NULL THEN ga ELSE 0 END AS BIGINT) AS part FROM a7)"""


@query("remainder_allocation", f"""WITH {GRP}, rs AS (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN discount_amount ELSE 0 END AS opt_price FROM gr)
  {remainder_sql('rs', 'order_id', 'order_amount', 'menu_price', 'qty', 'opt_price')} SELECT order_id, item_seq, menu_group, part FROM alloc""")
def remainder_allocation(t):
    hot = hot_orders(t)
    rows = grouped(t, hot).withColumn("opt_price", F.when(F.col("l_suppkey") % 2 == 0, F.col("discount_amount")).otherwise(0))
    rows = rows.select("order_id", "item_seq", "menu_group", "menu_price", "qty", "opt_price", "order_amount")
    out = o.remainder_allocation(rows, K, "menu_group", "menu_price", "qty", "opt_price", "order_amount", "part", hot=hot)
    return out.select("order_id", "item_seq", "menu_group", "part")


@query("first_nonzero_spread", f"""WITH {OL}, v AS (SELECT order_id, item_seq, CASE WHEN l_linenumber % 3 = 0 THEN net_amount ELSE 0 END AS x FROM ol)
  SELECT order_id, item_seq, COALESCE(first_value(NULLIF(x, 0) IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY item_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), max(x) OVER (PARTITION BY order_id)) AS amount FROM v""")
def first_nonzero_spread(t):
    x = F.when(F.col("l_linenumber") % 3 == 0, F.col("net_amount")).otherwise(0)
    hot = hot_orders(t)
    rows = order_lines(t, hot).select("order_id", "item_seq", x.alias("x"))
    return o.first_nonzero_spread(rows, K, "x", "amount", hot=hot).drop("x")


@query("order_time_unify", f"""WITH {OL}, v AS (SELECT order_id, item_seq, CASE WHEN l_linenumber % 2 = 0 THEN substr(order_time, 1, 5) || ':0' || (l_partkey % 10) END AS x FROM ol)
  SELECT order_id, item_seq, COALESCE(first_value(x IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY item_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') AS order_time FROM v""")
def order_time_unify(t):
    x = F.when(
        F.col("l_linenumber") % 2 == 0, F.concat(F.substring("order_time", 1, 5), F.lit(":0"), F.col("l_partkey") % 10)
    ).otherwise(" ")
    hot = hot_orders(t)
    return o.order_time_unify(order_lines(t, hot).select("order_id", "item_seq", x.alias("order_time")), K, hot=hot)


def adjust_sql(src, keys, extra=""):
    return f""", d0 AS (SELECT {keys}, CAST(sum(total_price) AS BIGINT) AS s, max(item_seq) AS mx, arg_min(order_amount, item_seq) AS head FROM {src} GROUP BY {keys}),
  rp AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY abs(total_price) DESC, item_seq) = 1)"""


@query("adjustment_rows", f"""WITH {OL} {adjust_sql('ol', 'order_id')}
  SELECT order_id, item_seq, item_id, item_name, qty, unit_price, total_price, sale_type, store FROM ol
  UNION ALL SELECT order_id, mx + 1, '__ADJ__', '정산차액', 1, abs(head - s), head - s, CASE WHEN head - s >= 0 THEN '정상' ELSE '취소' END, rp.store
  FROM d0 JOIN rp USING (order_id) WHERE head <> s""")
def adjustment_rows(t):
    hot = hot_orders(t)
    rows = order_lines(t, hot).select(
        "order_id", "item_seq", "item_id", "item_name", "qty", "unit_price", "total_price", "sale_type", "store", "order_amount"
    )
    return o.adjustment_rows(rows, K, "order_amount", hot=hot).drop("order_amount")


@query("latest_per_key", f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE)::VARCHAR AS shipped FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LINE_SEQ}) = 1""")
def latest_per_key(t):
    rows = o.latest_per_key(t.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("shipped"))


@query("is_latest_flag", f"""WITH {PRODUCTS} SELECT code, name, size, CASE WHEN row_number() OVER (PARTITION BY name, brand ORDER BY size DESC, code DESC) = 1
  THEN 'Y' ELSE 'N' END AS is_latest FROM products""")
def is_latest_flag(t):
    return o.is_latest_flag(t.products, ["name", "brand"], "size", "code").select("code", "name", "size", "is_latest")


@query("canonical_line_dedup", f"""WITH d AS (SELECT *, 1 AS run FROM lineitem UNION ALL SELECT *, 2 FROM lineitem WHERE l_returnflag <> 'N')
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT) AS qty, max(run) AS run FROM d
  GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice""")
def canonical_line_dedup(t):
    l = t.table("lineitem")
    twice = l.withColumn("run", F.lit(1)).unionByName(l.where(F.col("l_returnflag") != "N").withColumn("run", F.lit(2)))
    cols = {"l_orderkey": True, "l_partkey": False, "l_suppkey": False, "l_linenumber": False, "l_quantity": True, "l_extendedprice": True}
    out = o.canonical_line_dedup(twice, cols, [F.col("run").desc(), *LINE_ORDER])
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"), "run")


@query("receipt_dedup", """SELECT o_custkey, o_orderpriority, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sale_date, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL""")
def receipt_dedup(t):
    h = t.table("orders").withColumn("sale_date", F.col("o_orderdate").cast("date"))
    out = o.receipt_dedup(h, ["o_custkey", "o_orderpriority", "o_orderstatus", "sale_date", "pos_no"], [F.col("o_orderkey").desc()])
    return out.select("o_custkey", "o_orderpriority", "o_orderstatus", "sale_date", "o_orderkey")
