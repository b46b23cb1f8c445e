"""Filters, reconciliation and quality checks."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, LINES, REVIEWS, big, pct, query, ratio, rint, rnd, tint
from tillbook.catalog.c02_series import QUOTES, quotes, roll
from tillbook.catalog.c03_joins import RECON
from tillbook.catalog.c04_marts import CSMART, cs_mart
from tillbook.catalog.c06_order_lines import NAME, OL, hot_orders, item_name, order_lines
from tillbook.functions.clean import item_key
from tillbook.operators import filters as fl
from tillbook.plans import marts, reconcile as rc
from tillbook.sources.fixtures import AS_OF

D = "CAST(sale_date AS VARCHAR) AS sale_date"

BL = LINES + f""", nl AS (SELECT *, {NAME} AS item_name FROM lines), bl AS (SELECT *, CASE WHEN item_name IN ('배달비', 'ITEM 7') THEN true
  WHEN item_name = '토핑추가' AND store IN ('NATION_1', 'NATION_2') THEN true ELSE false END AS gone FROM nl)"""


def blacklist(t):
    """Two items for all stores, one for two stores."""
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"))
    names = p.select(item_name().alias("item_name")).distinct()
    listed = names.where(F.col("item_name").isin("배달비", "ITEM 7", "토핑추가"))
    return listed.select(
        item_key("item_name").alias("item_key"),
        F.when(F.col("item_name") == "토핑추가", "NATION_1, NATION_2").otherwise("").alias("stores"),
    )


def named(t):
    return t.lines.withColumn("item_name", item_name())


@query("store_scoped_blacklist", f"WITH {BL} SELECT l_orderkey, l_linenumber, l_partkey, store, item_name FROM bl WHERE NOT gone")
def store_scoped_blacklist(t):
    out = fl.store_scoped_blacklist(named(t), blacklist(t), item_key("item_name"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "store", "item_name")


@query("exclusion_report", f"""WITH {BL} SELECT ym, store, item_name, count(*) AS lines, {big('sum(qty)')} AS qty, {big('sum(total_price)')} AS amount,
  string_agg(DISTINCT CAST(sale_date AS VARCHAR), ',' ORDER BY CAST(sale_date AS VARCHAR)) AS days FROM bl WHERE gone GROUP BY ym, store, item_name""")
def exclusion_report(t):
    return fl.exclusion_report(fl.store_scoped_blacklist(named(t), blacklist(t), item_key("item_name"), removed=True))


@query("exclude_overlapping_stores", f"""WITH {HEADS} SELECT order_id, sale_date::VARCHAR AS sale_date, store FROM heads WHERE source <> 'P'
  AND (store, sale_date) NOT IN (SELECT store, sale_date FROM heads WHERE source = 'P')""")
def exclude_overlapping_stores(t):
    low, high = t.heads.where(F.col("source") != "P"), t.heads.where(F.col("source") == "P")
    return fl.exclude_overlapping_stores(low, high, ["store", "sale_date"]).select("order_id", "sale_date", "store")


@query("invalid_date_filter", f"""WITH {HEADS} SELECT order_id, CAST(sale_date + INTERVAL 25 YEAR AS DATE)::VARCHAR AS d FROM heads WHERE o_orderkey % 3 < 2 AND year(sale_date) + 25 <= 2024""")
def invalid_date_filter(t):
    k, d = F.col("o_orderkey") % 3, F.add_months("sale_date", 300)
    raw = F.when(k == 0, F.date_format(d, "yyyy/MM/dd")).when(k == 1, F.date_format(d, " yyyyMMdd ")).otherwise("soon")
    return fl.invalid_date_filter(t.heads.select("order_id", raw.alias("w")), "w", "d", "2020-01-01", "2024-12-31").drop("w")


@query("missing_settlement_check", f"""WITH {LINES} SELECT store, manager, source, count(*) AS rows, {big('sum(net_amount)')} AS paid FROM lines
  WHERE net_amount > 0 AND COALESCE(CASE WHEN l_linestatus = 'O' THEN settle_amount WHEN l_partkey % 2 = 0 THEN 0 END, 0) = 0 GROUP BY store, manager, source""")
def missing_settlement_check(t):
    settled = F.when(F.col("l_linestatus") == "O", F.col("settle_amount")).when(F.col("l_partkey") % 2 == 0, 0)
    return fl.missing_settlement_check(t.lines.withColumn("settled", settled), ["store", "manager", "source"], "net_amount", "settled")


@query("voc_drop_alert", f"""WITH {REVIEWS}, g AS (SELECT d, store, manager, n_chars % 40 AS now, n_chars % 30 AS before FROM rev
    QUALIFY row_number() OVER (PARTITION BY d, store ORDER BY doc_id) = 1), p AS (SELECT *, {pct('now', 'before', 4)} AS pct_change_30d FROM g)
  SELECT CAST(d AS VARCHAR) AS d, store, manager, pct_change_30d FROM p WHERE d = DATE '2024-01-20' AND pct_change_30d < 0""")
def voc_drop_alert(t):
    from tillbook.functions.numbers import pct as pc
    from tillbook.operators.core import keep_one

    one = keep_one(t.reviews, ["d", "store"], ["doc_id"]).select(
        "d", "store", "manager", pc(F.col("n_chars") % 40, F.col("n_chars") % 30, 4).alias("pct_change_30d")
    )
    return fl.voc_drop_alert(one, t.reviews.select("store", "manager").distinct(), "2024-01-21")


@query("price_anomaly", f"""WITH {QUOTES}, l AS (SELECT site, base_date, price, lag(price) OVER (PARTITION BY site ORDER BY base_date) AS prev_price FROM quotes)
  SELECT site, CAST(base_date AS VARCHAR) AS base_date, price, prev_price, {pct('price', 'prev_price')} AS change_pct,
    CASE WHEN price <= 0 THEN 'invalid' WHEN abs({ratio('(price - prev_price)', 'prev_price')}) >= CAST(0.2 AS DOUBLE) THEN CASE WHEN price > prev_price THEN 'jump' ELSE 'drop' END END AS reason FROM l""")
def price_anomaly(t):
    return fl.price_anomaly(quotes(t).drop("collected_at"), ["site"], "base_date", "price")


@query("due_pending_split", f"""WITH {EVENTS}, a AS (SELECT event_id, CASE WHEN k % 7 > 0 THEN d END AS action_date, CASE WHEN k % 2 = 0 THEN '조치' ELSE '미조치' END AS kind FROM ev)
  SELECT event_id, CAST(action_date AS VARCHAR) AS action_date, kind, CASE WHEN action_date + 7 <= DATE '2024-01-20' THEN 'due' ELSE 'pending' END AS part FROM a
  WHERE NOT (COALESCE(action_date + 7 <= DATE '2024-01-20', false) AND kind <> '조치')""")
def due_pending_split(t):
    acts = t.events.select(
        "event_id", F.when(F.col("k") % 7 > 0, F.col("d")).alias("action_date"),
        F.when(F.col("k") % 2 == 0, "조치").otherwise("미조치").alias("kind"),
    )
    due, pending = fl.due_pending_split(acts, "2024-01-20")
    return due.withColumn("part", F.lit("due")).unionByName(pending.withColumn("part", F.lit("pending")))


@query("final_column_whitelist", f"WITH {HEADS} SELECT order_id, store AS shop, order_amount FROM heads")
def final_column_whitelist(t):
    return fl.final_columns(t.heads, ["order_id", "store", "memo", "order_amount"], {"store": "shop", "memo": "note"})


@query("order_max_then_sum", f"""WITH {LINES}, o AS (SELECT sale_date, store, order_id, max(order_amount) AS a FROM lines GROUP BY ALL)
  SELECT {D}, store, {big('sum(a)')} AS amount FROM o GROUP BY sale_date, store""")
def order_max_then_sum(t):
    return rc.order_max_then_sum(t.lines, "order_id", ["sale_date", "store"], "order_amount")


GROUPS = {"A": ("AUTOMOBILE", "BUILDING"), "B": ("FURNITURE", "HOUSEHOLD", "MACHINERY")}
SRC = ("unified", "report", "mac_a", "mac_b")
EXPECT = {"A": ("unified", "report", "mac_a"), "B": ("unified", "report", "mac_b")}


def compare_sql():
    pv = ", ".join(f"""max(CASE WHEN source = '{s}' THEN 1 ELSE 0 END) AS present_{s}, {big(f"COALESCE(sum(amount) FILTER (source = '{s}'), 0)")} AS amt_{s}""" for s in SRC)
    want = lambda s: "platform_group IN (" + ", ".join(f"'{g}'" for g, ss in EXPECT.items() if s in ss) + ")"
    amounts = "[" + ", ".join(f"CASE WHEN {want(s)} THEN amt_{s} END" for s in SRC) + "]"
    have = lambda s: f"({want(s)} AND present_{s} = 1)"
    lack = lambda s: f"({want(s)} AND present_{s} = 0)"
    cnt = lambda f: " + ".join(f"CASE WHEN {f(s)} THEN 1 ELSE 0 END" for s in SRC)
    issue = lambda s: f"""CASE WHEN NOT {want(s)} THEN '비교대상아님' WHEN {lack(s)} THEN '누락' WHEN gap_rate >= 2 AND amt_{s} < amt_max THEN '차이_낮음'
      WHEN gap_rate >= 2 AND amt_{s} > amt_min THEN '차이_높음' ELSE '정상' END"""
    miss = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {lack(s)} THEN '{s}' END" for s in SRC) + "], lambda x: x IS NOT NULL), ',')"
    notes = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN issue_{s} NOT IN ('정상', '비교대상아님') THEN '{s} ' || issue_{s} END" for s in SRC) + "], lambda x: x IS NOT NULL), ',')"
    return f""", long AS (
    SELECT sale_date, store, CASE WHEN platform IN ('AUTOMOBILE', 'BUILDING') THEN 'A' ELSE 'B' END AS platform_group, 'unified' AS source, net_amount AS amount FROM lines
    UNION ALL SELECT sale_date, store, CASE WHEN platform IN ('AUTOMOBILE', 'BUILDING') THEN 'A' ELSE 'B' END, 'report', order_amount FROM heads WHERE source <> 'P'
    UNION ALL SELECT sale_date, store, 'A', 'mac_a', net_amount FROM lines WHERE platform IN ('AUTOMOBILE', 'BUILDING') AND l_linenumber < 7
    UNION ALL SELECT sale_date, store, 'B', 'mac_b', net_amount FROM lines WHERE platform NOT IN ('AUTOMOBILE', 'BUILDING') AND l_returnflag <> 'R'),
  p AS (SELECT sale_date, store, platform_group, {pv} FROM long GROUP BY ALL),
  q AS (SELECT *, CAST({cnt(have)} AS BIGINT) AS n_present, CAST({cnt(want)} AS BIGINT) AS n_expected,
    CASE {' '.join(f"WHEN {have(s)} THEN '{s}'" for s in SRC)} ELSE '' END AS baseline_source, CASE {' '.join(f"WHEN {have(s)} THEN amt_{s}" for s in SRC)} ELSE 0 END AS baseline_amt,
    list_max({amounts}) AS amt_max, list_min({amounts}) AS amt_min, {miss} AS missing_sources FROM p),
  r AS (SELECT *, amt_max - amt_min AS gap, COALESCE({rnd(ratio('(amt_max - amt_min)', 'amt_max') + ' * 100')}, 0.0) AS gap_rate FROM q),
  s AS (SELECT *, CASE WHEN missing_sources <> '' THEN '누락' WHEN gap_rate >= 2 THEN '차이' ELSE '정상' END AS status, {', '.join(f"{issue(x)} AS issue_{x}" for x in SRC)} FROM r)
  SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), {notes} AS issue_summary FROM s"""


@query("collection_compare", f"WITH {LINES} {compare_sql()}")
def collection_compare(t):
    grp = F.when(F.col("platform").isin(*GROUPS["A"]), "A").otherwise("B")
    part = lambda df, src, amt: df.groupBy("sale_date", "store", grp.alias("platform_group")).agg(F.sum(amt).alias("amount")).withColumn("source", F.lit(src))
    a = F.col("platform").isin(*GROUPS["A"])
    long = (
        part(t.lines, "unified", "net_amount")
        .unionByName(part(t.heads.where(F.col("source") != "P"), "report", "order_amount"))
        .unionByName(part(t.lines.where(a & (F.col("l_linenumber") < 7)), "mac_a", "net_amount"))
        .unionByName(part(t.lines.where(~a & (F.col("l_returnflag") != "R")), "mac_b", "net_amount"))
    )
    return rc.collection_compare(long, SRC, EXPECT)


@query("order_vs_item_totals", f"""WITH {LINES}, a AS (SELECT sale_date, store, {big('sum(order_amount)')} AS order_sum FROM heads GROUP BY ALL),
  b AS (SELECT sale_date, store, {big('sum(net_amount)')} AS item_sum FROM lines GROUP BY ALL), n AS (SELECT DISTINCT sale_date, store FROM heads WHERE platform = 'BUILDING'),
  j AS (SELECT sale_date, store, order_sum, item_sum, CASE WHEN order_sum IS NULL OR item_sum IS NULL THEN 'empty_side' WHEN abs(order_sum - item_sum) > 50000 THEN 'mismatch' END AS issue
    FROM a FULL JOIN b USING (sale_date, store) WHERE (sale_date, store) NOT IN (SELECT sale_date, store FROM n))
  SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date) FROM j WHERE issue IS NOT NULL""")
def order_vs_item_totals(t):
    heads = t.heads.withColumn("amount", F.col("order_amount"))
    items = t.lines.withColumn("amount", F.col("net_amount"))
    return rc.order_vs_item_totals(heads, items, t.heads.where(F.col("platform") == "BUILDING"), 50_000)


DAILY = LINES + f""", dd AS (SELECT sale_date, store, {big('sum(list_amount)')} AS gross, {big('sum(discount_amount)')} AS discount, {big('sum(net_amount)')} AS net, count(*) AS receipts
  FROM lines GROUP BY ALL), rep AS (SELECT sale_date, store, {big('sum(net_amount)')} AS net, count(*) AS receipts FROM lines WHERE l_linenumber < 7 GROUP BY ALL)"""


@query("daily_from_orders", f"""WITH {DAILY} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store, gross, discount, dd.net, dd.receipts, rep.net AS reported_net, rep.receipts AS reported_receipts,
  CASE WHEN dd.net = rep.net AND dd.receipts = rep.receipts THEN 1 ELSE 0 END AS ok FROM dd FULL JOIN rep USING (sale_date, store)""")
def daily_from_orders(t):
    rows = t.lines.withColumnsRenamed({"list_amount": "gross", "discount_amount": "discount", "net_amount": "net"})
    derived = rc.daily_from_orders(rows)
    reported = rows.where(F.col("l_linenumber") < 7).groupBy("sale_date", "store").agg(F.sum("net").alias("net"), F.count(F.lit(1)).alias("receipts"))
    return rc.check_against_daily(derived, reported)


@query("platform_vs_report", f"""WITH {LINES}, o AS (SELECT sale_date, store, order_id, max(order_amount) AS a FROM lines WHERE source <> 'P' GROUP BY ALL),
  own AS (SELECT sale_date, store, {big('sum(a)')} AS own FROM o GROUP BY ALL),
  net AS (SELECT sale_date, store, {big("sum(CASE WHEN source = 'P' THEN -order_amount ELSE order_amount END)")} AS own FROM heads GROUP BY ALL),
  rp AS (SELECT sale_date, store, CASE WHEN dayofmonth(sale_date) = 5 THEN 0 ELSE {big("COALESCE(sum(order_amount) FILTER (source <> 'P'), 0)")} END AS reported FROM heads GROUP BY sale_date, store),
  u AS (SELECT 'orders' AS side, sale_date, store, COALESCE(reported, 0) AS reported, COALESCE(own, 0) AS own FROM rp FULL JOIN own USING (sale_date, store)
    UNION ALL SELECT 'net', sale_date, store, COALESCE(reported, 0), COALESCE(own, 0) FROM rp FULL JOIN net USING (sale_date, store))
  SELECT side, {D}, store, reported, own, CASE WHEN reported = 0 AND own = 0 THEN 'no_delivery' WHEN reported = 0 AND own > 0 THEN 'report_gap' WHEN reported = own THEN 'matched' ELSE 'mismatch' END AS kind FROM u""")
def platform_vs_report(t):
    reported = F.coalesce(F.sum(F.when(F.col("source") != "P", F.col("order_amount"))), F.lit(0))
    report = t.heads.groupBy("sale_date", "store").agg(reported.alias("reported")).withColumn(
        "reported", F.when(F.dayofmonth("sale_date") == 5, 0).otherwise(F.col("reported"))
    )
    rows = lambda df: df.select("sale_date", "store", "order_id", F.col("order_amount").alias("amount"), (F.col("source") == "P").alias("cancelled"))
    a = rc.platform_vs_report(rows(t.lines), report).withColumn("side", F.lit("orders"))
    b = rc.platform_vs_report(rows(t.heads), report, cancelled_minus=True).withColumn("side", F.lit("net"))
    return a.unionByName(b)


@query("brand_coverage", f"""WITH {LINES}, e AS (SELECT DISTINCT store, platform AS brand FROM heads UNION SELECT store, 'NEW' FROM stores WHERE store_key < 5),
  x AS (SELECT DISTINCT store, platform AS brand FROM heads), a AS (SELECT DISTINCT store, platform AS brand FROM heads WHERE ym = '2001-07' AND source = 'F'),
  j AS (SELECT e.store, e.brand, x.brand AS xb, a.brand AS ab FROM e LEFT JOIN x ON x.store = e.store AND x.brand = e.brand LEFT JOIN a ON a.store = e.store AND a.brand = e.brand),
  g AS (SELECT store, string_agg(brand, ',' ORDER BY brand) AS expected_brands, COALESCE(string_agg(ab, ',' ORDER BY ab), '') AS active_brands,
    COALESCE(string_agg(brand, ',' ORDER BY brand) FILTER (xb IS NULL), '') AS missing_brands, COALESCE(string_agg(brand, ',' ORDER BY brand) FILTER (xb IS NOT NULL AND ab IS NULL), '') AS stale_brands FROM j GROUP BY store)
  SELECT *, CASE WHEN missing_brands <> '' THEN 'missing_partition' WHEN stale_brands <> '' THEN 'stale_partition' END AS issue_type FROM g""")
def brand_coverage(t):
    rows = t.heads.select("store", F.col("platform").alias("brand"), "ym", "source")
    extra = t.stores.where(F.col("store_key") < 5).select("store", F.lit("NEW").alias("brand"))
    day = rows.where((F.col("ym") == "2001-07") & (F.col("source") == "F"))
    return rc.brand_coverage(rows.select("store", "brand").unionByName(extra), rows, day)


@query("count_amount_check", f"""WITH {LINES}, g AS (SELECT ym, store, count(DISTINCT order_id) FILTER (platform <> 'BUILDING') AS actual_count, sum(net_amount) AS a, sum(list_amount) AS b, sum(settle_amount) AS c FROM lines GROUP BY ALL),
  e AS (SELECT ym, store, CASE WHEN store = 'NATION_4' THEN count(*) + 1 ELSE count(DISTINCT order_id) FILTER (platform <> 'BUILDING') END AS expected_count, {big("CASE WHEN ym < '1998' THEN sum(list_amount) WHEN ym < '2000' THEN sum(settle_amount) ELSE 7 END")} AS expected_amount
    FROM lines WHERE region <> 'ASIA' GROUP BY ym, store UNION ALL SELECT '2030-01', store, 0, CASE WHEN region = 'ASIA' THEN 0 ELSE 5 END FROM stores),
  j AS (SELECT ym, store, coalesce(actual_count, 0) AS actual_count, expected_count, expected_amount, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c FROM g FULL JOIN e USING (ym, store))
  SELECT ym, store, actual_count, expected_count, expected_amount, CASE WHEN a = expected_amount THEN 'net_amount' WHEN b = expected_amount THEN 'list_amount' WHEN c = expected_amount THEN 'settle_amount' ELSE 'net_amount' END AS amount_source,
    CASE WHEN expected_count IS NULL THEN NULL WHEN actual_count = expected_count AND expected_amount IN (a, b, c) THEN 1 ELSE 0 END AS matched FROM j""")
def count_amount_check(t):
    # The lines of one platform carry a blank order id; every store has a summary for a month without rows.
    amt = F.when(F.col("ym") < "1998", F.sum("list_amount")).when(F.col("ym") < "2000", F.sum("settle_amount")).otherwise(7)
    lines = t.lines.withColumn("order_id", F.when(F.col("platform") == "BUILDING", " ").otherwise(F.col("order_id")))
    orders = F.countDistinct(F.when(F.col("order_id") != " ", F.col("order_id")))
    cnt = F.when(F.col("store") == "NATION_4", F.count(F.lit(1)) + 1).otherwise(orders)
    expected = lines.where(F.col("region") != "ASIA").groupBy("ym", "store").agg(cnt.alias("expected_count"), amt.alias("expected_amount"))
    still = t.stores.select(F.lit("2030-01").alias("ym"), "store", F.lit(0).cast("bigint").alias("expected_count"), F.when(F.col("region") == "ASIA", 0).otherwise(5).cast("bigint").alias("expected_amount"))
    return rc.count_amount_check(lines, expected.unionByName(still), ["ym", "store"], "order_id", ["net_amount", "list_amount", "settle_amount"])


@query("snapshot_shrink_check", f"""WITH {HEADS}, a AS (SELECT sale_date, count(*) AS new_count FROM heads WHERE source <> 'P' OR ym < '1999' GROUP BY ALL), b AS (SELECT sale_date, count(*) AS prev_count FROM heads GROUP BY ALL)
  SELECT {D}, new_count, prev_count FROM a JOIN b USING (sale_date) WHERE new_count < prev_count * 0.95""")
def snapshot_shrink_check(t):
    return rc.snapshot_shrink_check(t.heads.where((F.col("source") != "P") | (F.col("ym") < "1999")), t.heads, "sale_date")


@query("monthly_amount_integrity", f"""WITH {LINES}, a AS (SELECT ym, store, {big('sum(order_amount)')} AS reported FROM heads WHERE ym < '{AS_OF[:7]}' GROUP BY ALL), b AS (SELECT ym, store, {big('sum(net_amount)')} AS unified FROM lines WHERE ym < '{AS_OF[:7]}' GROUP BY ALL),
  j AS (SELECT ym, store, COALESCE(reported, 0) AS reported, COALESCE(unified, 0) AS unified FROM a FULL JOIN b USING (ym, store)),
  e AS (SELECT *, unified - reported AS difference, COALESCE({rnd(ratio('abs(unified - reported)', 'abs(reported)') + ' * 100')}, 0.0) AS error_rate FROM j) SELECT *, CASE WHEN error_rate >= 2 THEN 'error' ELSE 'ok' END AS status FROM e""")
def monthly_amount_integrity(t):
    return rc.monthly_amount_integrity(t.heads.withColumn("amount", F.col("order_amount")), t.lines.withColumn("amount", F.col("net_amount")), AS_OF)


@query("mart_quality_checks", f"""WITH {CSMART}, dup AS (SELECT COALESCE(sum(n - 1), 0) AS n FROM (SELECT month, count(*) AS n FROM cs GROUP BY month)),
  c AS (SELECT 'duplicate_key' AS "check", {big('n')} AS bad_rows FROM dup UNION ALL SELECT 'done_without_date', count(*) FILTER (is_done = 1 AND done_date IS NULL) FROM cs
    UNION ALL SELECT 'open_with_date', count(*) FILTER (is_done = 0 AND done_date IS NOT NULL) FROM cs UNION ALL SELECT 'negative_duration', count(*) FILTER (duration_days < 0) FROM cs
    UNION ALL SELECT 'no_duration', count(*) FILTER (duration_days IS NULL) FROM cs UNION ALL SELECT 'month_mismatch', count(*) FILTER (month <> strftime(registered, '%Y-%m')) FROM cs)
  SELECT *, CASE WHEN bad_rows = 0 THEN 1 ELSE 0 END AS ok FROM c""")
def mart_quality_checks(t):
    c = F.col
    rules = {
        "done_without_date": (c("is_done") == 1) & c("done_date").isNull(), "open_with_date": (c("is_done") == 0) & c("done_date").isNotNull(),
        "negative_duration": c("duration_days") < 0, "no_duration": c("duration_days").isNull(),
        "month_mismatch": c("month") != F.date_format("registered", "yyyy-MM"),
    }
    return rc.mart_quality_checks(cs_mart(t), ["month"], rules)


@query("join_retention", f"WITH {HEADS} SELECT count(*) AS before, (SELECT count(*) FROM heads JOIN stores USING (store)) AS after, CASE WHEN count(*) = (SELECT count(*) FROM heads JOIN stores USING (store)) THEN 1 ELSE 0 END AS kept FROM heads")
def join_retention(t):
    return rc.join_retention(t.heads, t.heads.join(t.stores.select("store", "store_key"), "store", "left"))


RUNS = EVENTS + """, tasks AS (SELECT store AS job, CAST(d AS VARCHAR) AS run_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' WHEN 'view' THEN CASE WHEN k % 9 = 0 THEN 'upstream_failed' ELSE 'success' END ELSE 'success' END AS state, ts, amount FROM ev WHERE NOT (event_type = 'error' AND k % 2 = 0)),
  runs AS (SELECT job, run_id, min(ts) AS run_at, CASE WHEN count(*) FILTER (state = 'failed') > 1 THEN 'failed' ELSE 'success' END AS run_state, CAST(min(amount) AS DOUBLE) / 10 AS seconds FROM tasks GROUP BY job, run_id)"""


def tasks(t):
    e, k = F.col("event_type"), F.col("k")
    state = F.when(e == "error", "failed").when(e == "signup", "skipped").when((e == "view") & (k % 9 == 0), "upstream_failed").otherwise("success")
    return t.events.where(~((e == "error") & (k % 2 == 0))).select(
        F.col("store").alias("job"), F.date_format("d", "yyyy-MM-dd").alias("run_id"), state.alias("state"), "ts", "amount"
    )


def runs(t):
    return tasks(t).groupBy("job", "run_id").agg(
        F.min("ts").alias("run_at"), F.when(F.count(F.when(F.col("state") == "failed", 1)) > 1, "failed").otherwise("success").alias("run_state"),
        (F.min("amount").cast("double") / 10).alias("seconds"),
    )


@query("dag_run_health", f"""WITH {RUNS}, l AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY job ORDER BY run_at DESC, run_id DESC) = 1),
  c AS (SELECT job, run_id, count(*) AS total, count(*) FILTER (state = 'success') AS success, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'skipped') AS skipped, count(*) FILTER (state = 'upstream_failed') AS upstream_failed FROM tasks GROUP BY ALL),
  j AS (SELECT l.job, l.run_id, strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at, run_state, seconds, total, success, failed, skipped, upstream_failed, skipped > 0 AND failed = 0 AND upstream_failed = 0 AND run_state = 'success' AND success + skipped = total AS planned FROM l JOIN c ON c.job = l.job AND c.run_id = l.run_id),
  k AS (SELECT * EXCLUDE (planned), CASE WHEN run_state = 'failed' THEN 'run_failed' WHEN skipped * 2 >= total AND NOT planned THEN 'high_skip_ratio' WHEN upstream_failed > 0 THEN 'upstream_failed' WHEN skipped = total THEN 'all_skipped' WHEN NOT planned AND seconds > 0 AND seconds < 200 THEN 'short_duration' END AS fail_type FROM j)
  SELECT *, CASE WHEN fail_type IN ('run_failed', 'high_skip_ratio', 'upstream_failed') THEN 'FAIL' WHEN fail_type IS NOT NULL THEN 'WARN' ELSE 'OK' END AS verdict FROM k""")
def dag_run_health(t):
    return rc.run_health(runs(t), tasks(t), 200.0)


@query("run_start_hours", f"WITH {RUNS} SELECT CAST(hour(run_at) AS BIGINT) AS hour, count(*) AS runs FROM runs GROUP BY 1")
def run_start_hours(t):
    return rc.start_hours(runs(t))


@query("unresolved_failures", f"""WITH {EVENTS}, r AS (SELECT store AS job, 'r' || event_id AS run_id, ts AS run_at, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS run_state FROM ev),
  l AS (SELECT * FROM r WHERE CAST(run_at AS DATE) = DATE '2024-01-15' QUALIFY row_number() OVER (PARTITION BY job ORDER BY run_at DESC, run_id DESC) = 1)
  SELECT job, run_id, strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at, run_state FROM l WHERE run_state = 'failed'""")
def unresolved_failures(t):
    state = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    rows = t.events.select(F.col("store").alias("job"), F.concat(F.lit("r"), "event_id").alias("run_id"), F.col("ts").alias("run_at"), state.alias("run_state"))
    return rc.unresolved_failures(rows, "2024-01-15")


@query("source_collisions", f"""WITH {HEADS}, s AS (SELECT CASE WHEN source = 'P' THEN '' WHEN source = 'O' AND platform = 'BUILDING' THEN 'o ' ELSE source END AS raw FROM heads),
  g AS (SELECT lower(trim(raw)) AS name, count(*) AS rows, count(DISTINCT raw) AS spellings, string_agg(DISTINCT raw, '|' ORDER BY raw) AS variants FROM s GROUP BY 1)
  SELECT *, CASE WHEN name = '' THEN 'blank' ELSE 'collision' END AS issue FROM g WHERE name = '' OR spellings > 1""")
def source_collisions(t):
    raw = F.when(F.col("source") == "P", None).when((F.col("source") == "O") & (F.col("platform") == "BUILDING"), "o ").otherwise(F.col("source"))
    return rc.source_collisions(t.heads.select(raw.alias("source")))


OPS = EVENTS + """, chg AS (SELECT store, event_id, date_trunc('second', ts) AS ts, CASE WHEN event_type = 'signup' THEN 'holiday' ELSE 'pause' END AS kind, d, k,
    CASE WHEN event_type = 'signup' AND k % 5 = 0 THEN k % 7 END AS reg_day, CASE WHEN event_type = 'signup' AND k % 3 = 0 THEN true ELSE false END AS sets,
    CASE WHEN event_type = 'signup' AND k % 4 = 0 THEN true ELSE false END AS cancels FROM ev WHERE event_type IN ('signup', 'error'))"""


def changes(t):
    k, sign = F.col("k"), F.col("event_type") == "signup"
    words = F.array(*[F.lit(w) for w in "월화수목금토일"])
    span = lambda lo, hi: F.concat_ws(" ~ ", F.date_format(F.date_add("d", lo), "yyyy-MM-dd"), F.date_format(F.date_add("d", hi), "yyyy-MM-dd"))
    hm = lambda c: F.date_format(c, "yy.MM.dd HH:mm")
    start = F.date_trunc("minute", "ts")
    pause = F.concat_ws(" ~ ", hm(start), hm(F.timestamp_add("MINUTE", (k * 3).cast("int"), start)))
    return t.events.where(F.col("event_type").isin("signup", "error")).select(
        "store", "event_id", F.date_trunc("second", "ts").alias("ts"), F.when(sign, "holiday").otherwise("pause").alias("kind"),
        F.when(sign & (k % 5 == 0), F.concat(F.lit("매주 "), F.get(words, (k % 7).cast("int")), F.lit("요일"))).otherwise("없음").alias("regular_after"),
        F.when(sign & (k % 4 == 0), span(-1, 3)).alias("temp_before"),
        F.when(sign & (k % 3 == 0), span(1, 4)).otherwise("없음").alias("temp_after"),
        F.when(~sign & (k % 2 == 0), pause).otherwise("없음").alias("pause_store"), F.when(~sign, pause).alias("pause_app"),
    )


@query("monthly_operation", f"""WITH {OPS}, mons AS (SELECT s.store, CAST(m AS DATE) AS m FROM (SELECT DISTINCT store FROM ev) s, generate_series(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 1 MONTH) x(m)),
  reg AS (SELECT mons.store, mons.m, (SELECT arg_max(c.reg_day, (c.ts, c.event_id)) FROM chg c WHERE c.store = mons.store AND c.reg_day IS NOT NULL AND c.d <= last_day(mons.m)) AS off FROM mons),
  tmp AS (SELECT store, CAST(unnest(generate_series(d + 1, d + 4, INTERVAL 1 DAY)) AS DATE) AS day, ts, event_id, 0 AS o FROM chg WHERE sets
    UNION ALL SELECT store, day, ts, event_id, 1 FROM (SELECT store, d, CAST(unnest(generate_series(d - 1, d + 3, INTERVAL 1 DAY)) AS DATE) AS day, ts, event_id FROM chg WHERE cancels) WHERE day >= d),
  ts AS (SELECT store, day, arg_max(o, (ts, event_id, o)) AS o FROM tmp GROUP BY ALL),
  cal AS (SELECT r.store, r.m, r.off, CAST(unnest(generate_series(r.m, least(last_day(r.m), DATE '2024-02-10'), INTERVAL 1 DAY)) AS DATE) AS day FROM reg r),
  cd AS (SELECT c.*, COALESCE(isodow(c.day) - 1 = c.off, false) AS regular, COALESCE(t.o = 0, false) AS temp, 8 + (isodow(c.day) - 1) * 0.25 AS h FROM cal c LEFT JOIN ts t ON t.store = c.store AND t.day = c.day),
  base AS (SELECT store, m, count(*) FILTER (NOT regular AND NOT temp) AS operating_days, count(*) FILTER (regular) AS regular_off, count(*) FILTER (temp AND NOT regular) AS temp_off, sum(h) FILTER (NOT regular AND NOT temp) AS bh FROM cd GROUP BY ALL),
  pz AS (SELECT DISTINCT store, ts, CAST(date_trunc('month', d) AS DATE) AS m, k % 2 = 0 AS whole, k * 3 AS mins FROM chg WHERE kind = 'pause'),
  pa AS (SELECT store, m, count(*) FILTER (whole AND mins > 0) AS pc, sum(round_even(CAST(mins / 60.0 AS DECIMAL(18, 8)), 2)) FILTER (whole) AS ph, count(*) FILTER (NOT whole AND mins > 0) AS ac, sum(round_even(CAST(mins / 60.0 AS DECIMAL(18, 8)), 2)) FILTER (NOT whole) AS ah FROM pz GROUP BY ALL)
  SELECT b.store, strftime(b.m, '%Y-%m') AS ym, operating_days, regular_off, temp_off, {rnd('bh / operating_days')} AS avg_daily_hours, COALESCE(pc, 0) AS pause_count, CAST(COALESCE(ph, 0) AS DOUBLE) AS pause_hours,
    COALESCE(ac, 0) AS app_pause_count, CAST(COALESCE(ah, 0) AS DOUBLE) AS app_pause_hours, CAST(greatest(0, bh - COALESCE(ph, 0)) AS DOUBLE) AS store_hours, CAST(greatest(0, greatest(0, bh - COALESCE(ph, 0)) - COALESCE(ah, 0)) AS DOUBLE) AS app_hours
  FROM base b LEFT JOIN pa ON pa.store = b.store AND pa.m = b.m""")
def monthly_operation(t):
    week = F.explode(F.sequence(F.lit(0), F.lit(6)))
    hours = t.events.select("store").distinct().select("store", week.alias("weekday")).withColumn("hours", 8 + F.col("weekday") * 0.25)
    return rc.monthly_operation(changes(t), hours, "2024-01-01", "2024-02-10")


TYPES = {"main": "STANDARD", "size": "SMALL", "protein": "MEDIUM", "flavor": "LARGE", "topping": "ECONOMY", "side": "PROMO", "drink": "NONE"}


@query("order_structure", f"""WITH {OL}, l AS (SELECT o.order_id, o.sale_date, o.store, o.platform, o.item_seq, o.unit_price, p.p_name AS nm, p.p_type AS ty, o.order_type = '1-URGENT' AS hall, CASE WHEN o.l_suppkey % 9 = 0 THEN '배달비' WHEN o.l_suppkey % 3 = 0 THEN p.p_brand ELSE '' END AS menu, o.l_suppkey % 4 = 0 AS out
    FROM ol o JOIN part p ON p.p_partkey = o.l_partkey),
  g AS (SELECT order_id, sale_date, store, platform, COALESCE(arg_min(nm, item_seq) FILTER (ty = 'STANDARD'), arg_min(nm, item_seq) FILTER (contains(nm, 'ring')), arg_min(nm, (out, -unit_price, item_seq))) AS mm,
    COALESCE(arg_min(nm, item_seq) FILTER (ty = 'SMALL'), '') AS size_option, COALESCE(arg_min(nm, item_seq) FILTER (ty = 'MEDIUM'), '') AS protein_option, COALESCE(arg_min(nm, item_seq) FILTER (ty = 'LARGE'), '') AS flavor_option,
    COALESCE(string_agg(nm, ', ' ORDER BY item_seq) FILTER (ty = 'ECONOMY'), '') AS topping_list, COALESCE(string_agg(nm, ', ' ORDER BY item_seq) FILTER (ty = 'PROMO'), '') AS side_list, '' AS drink_list,
    arg_min(hall, item_seq) AS hall FROM l GROUP BY order_id, sale_date, store, platform),
  mn AS (SELECT order_id, string_agg(menu, ' | ' ORDER BY s) AS menus, arg_min(menu, s) AS m1 FROM (SELECT order_id, menu, min(item_seq) AS s FROM l WHERE menu NOT IN ('', '배달비') GROUP BY ALL) GROUP BY order_id)
  SELECT g.order_id, CAST(sale_date AS VARCHAR) AS sale_date, store, platform, CASE WHEN NOT hall AND menus IS NOT NULL THEN m1 ELSE mm END AS main_menu, size_option, protein_option, flavor_option, topping_list, side_list, drink_list,
    CASE WHEN NOT hall AND menus IS NOT NULL THEN menus ELSE concat_ws(' ', NULLIF(size_option, ''), NULLIF(protein_option, ''), NULLIF(mm, '')) END AS final_menu_name FROM g LEFT JOIN mn USING (order_id)""")
def order_structure(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("nm"), F.col("p_type").alias("item_type"), F.col("p_brand").alias("pb"))
    rows = order_lines(t, hot_orders(t)).drop("item_name").join(p, "l_partkey").select(
        "order_id", "sale_date", "store", "platform", "item_seq", "unit_price", F.col("nm").alias("item_name"), "item_type",
        F.when(F.col("order_type") == "1-URGENT", "홀_테이블").otherwise("배달").alias("order_type"),
        F.when(F.col("l_suppkey") % 9 == 0, "배달비").when(F.col("l_suppkey") % 3 == 0, F.col("pb")).otherwise("").alias("menu_name"),
        F.when(F.col("l_suppkey") % 4 == 0, "y").alias("exclude_check"),
    )
    return rc.order_structure(rows, TYPES, "ring")
