"""Targets, forecasts and report tables."""

from pyspark.sql import functions as F

from tillbook.catalog.base import HEADS, big, query, ratio, rint, rnd
from tillbook.catalog.c04_marts import ACT, WEEKLY_SLOTS, actuals, weekly_slots
from tillbook.plans import targets as tg

# Targets of a (month, store, brand): fixed day amounts per region; one region has none.
TARGET = ACT + """, tgt AS (SELECT DISTINCT l.ym, l.store, l.brand, CASE WHEN l.region = 'AFRICA' THEN NULL ELSE 40000 END AS weekday_target, 60000 AS weekend_target, 30000 AS target_price FROM lines l WHERE l.region <> 'ASIA')"""


def target_rows(t):
    return t.lines.where(F.col("region") != "ASIA").select(
        "ym", "store", "brand", F.when(F.col("region") != "AFRICA", 40_000).alias("weekday_target"),
        F.lit(60_000).alias("weekend_target"), F.lit(30_000).alias("target_price"),
    ).distinct()


ACHIEVED = TARGET + f""", done AS (SELECT DISTINCT sale_date FROM heads WHERE source = 'F' AND ym < '1996'),
  t0 AS (SELECT a.*, t.weekday_target, t.weekend_target, t.target_price, CASE WHEN day_kind = '평일' THEN weekday_target ELSE weekend_target END AS target
    FROM act a JOIN tgt t USING (ym, store, brand) WHERE a.sale_date NOT IN (SELECT sale_date FROM done)),
  t1 AS (SELECT *, total_sales - target AS diff, CASE WHEN target > 0 THEN {rnd(ratio('total_sales', 'target') + ' * 100', 1)} END AS rate, table_price - target_price AS price_diff,
    CASE WHEN total_sales > 0 THEN {rnd(ratio('hall_pack_sales', 'total_sales') + ' * 100', 1)} ELSE 0.0 END AS pack_share FROM t0),
  t2 AS (SELECT *, CASE WHEN rate IS NULL THEN '목표없음' WHEN rate >= 100 THEN 'A' WHEN rate >= 97 THEN 'B' WHEN rate >= 93 THEN 'C' ELSE 'D' END AS grade FROM t1),
  achieved AS (SELECT *, CASE grade WHEN '목표없음' THEN '목표없음' WHEN 'A' THEN '목표초과' WHEN 'B' THEN '목표근접' ELSE CASE WHEN table_price / 30000.0 < 0.9 AND tables < 20 THEN '유입과 구매단가 복합 문제'
    WHEN table_price / 30000.0 < 0.9 THEN '객단가/메뉴구성 문제' WHEN pack_share < 8 THEN '포장유입 부족' ELSE '테이블수 부족' END END AS diagnosis FROM t2)"""


def achieved(t):
    done = t.heads.where((F.col("source") == "F") & (F.col("ym") < "1996")).select("sale_date")
    return tg.target_achievement(actuals(t), target_rows(t), done)


@query("target_achievement", f"WITH {ACHIEVED} SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date) FROM achieved")
def target_achievement(t):
    return achieved(t)


@query("missing_targets", f"WITH {TARGET} SELECT DISTINCT ym, store, brand FROM act WHERE (ym, store, brand) NOT IN (SELECT (ym, store, brand) FROM tgt WHERE weekday_target IS NOT NULL)")
def missing_targets(t):
    return tg.missing_targets(t.lines, target_rows(t))


@query("backfill_columns", f"""WITH {ACHIEVED} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store, brand, target, CASE WHEN tables > 1 THEN total_sales * 2 ELSE total_sales END AS total_sales FROM achieved""")
def backfill_columns(t):
    fresh = achieved(t).select("sale_date", "store", "brand", "target", "total_sales", "tables")
    stored = fresh.select(
        "sale_date", "store", "brand", F.when(F.col("tables") > 1, F.col("target")).alias("target"),
        F.when(F.col("tables") > 1, F.col("total_sales") * 2).alias("total_sales"),
    )
    return tg.backfill_columns(stored, fresh, ["sale_date", "store", "brand"], ["target", "total_sales"])


MONTH_T = """mt AS (SELECT strftime(m, '%Y-%m') AS ym, 900000 + month(m) * 1000 AS sales, 30 + month(m) AS orders FROM generate_series(DATE '1995-01-01', DATE '2001-06-01', INTERVAL 1 MONTH) x(m)),
  md AS (SELECT ym, sales, orders, CAST(d AS DATE) AS d FROM (SELECT ym, sales, orders, unnest(generate_series(CAST(ym || '-01' AS DATE), last_day(CAST(ym || '-01' AS DATE)), INTERVAL 1 DAY)) AS d FROM mt)),"""


def month_targets(t):
    """Monthly targets by rule for the months the orders cover."""
    months = t.heads.where(F.col("ym") < "2001-07").select("ym").distinct()
    m = F.substring("ym", 6, 2).cast("int")
    return months.select("ym", (900_000 + m * 1000).alias("sales"), (30 + m).alias("orders"))


SPLIT = MONTH_T + f""" wsplit AS (SELECT ym, CAST(date_trunc('week', d) AS DATE) AS week_start, count(*) AS days, {rint("max(sales) / CAST(day(last_day(CAST(ym || '-01' AS DATE))) AS DOUBLE) * count(*)")} AS sales_target,
    {rint("max(orders) / CAST(day(last_day(CAST(ym || '-01' AS DATE))) AS DOUBLE) * count(*)")} AS orders_target FROM md GROUP BY 1, 2)"""


@query("weekly_target_split", f"WITH {SPLIT} SELECT ym, CAST(week_start AS VARCHAR) AS week_start, days, sales_target, orders_target FROM wsplit")
def weekly_target_split(t):
    return tg.weekly_target_split(month_targets(t), ["sales", "orders"])


TRACK = WEEKLY_SLOTS + ", " + SPLIT + f""", trk AS (SELECT w.*, COALESCE(s.sales_target, 0) AS sales_target, COALESCE(s.orders_target, 0) AS orders_target, {rnd(ratio('w.sales', 'COALESCE(s.sales_target, 0)') + ' * 100', 1)} AS sales_rate,
    {rnd(ratio('w.orders', 'COALESCE(s.orders_target, 0)') + ' * 100', 1)} AS orders_rate FROM ws w LEFT JOIN wsplit s ON s.ym = w.ym AND s.week_start = w.week_start)"""


def tracking(t):
    return tg.weekly_tracking(weekly_slots(t), tg.weekly_target_split(month_targets(t), ["sales", "orders"]), ["sales", "orders"])


@query("weekly_tracking", f"WITH {TRACK} SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM trk")
def weekly_tracking(t):
    return tracking(t)


def matrix_sql(m):
    mtd = f"sum({m}) OVER (PARTITION BY t.ym ORDER BY week_start)"
    return f"""SELECT t.ym, CAST(week_start AS VARCHAR) AS week_start, '{m}' AS metric, CAST(mt.{m} AS BIGINT) AS month_target, {big(mtd.replace(f'sum({m})', f'sum(t.{m})'))} AS mtd, {m}_target AS week_target, t.{m} AS wtd,
    {rnd(ratio(mtd.replace(f'sum({m})', f'sum(t.{m})'), f'mt.{m}') + ' * 100', 1)} AS month_rate, {rnd(ratio(f't.{m}', f'{m}_target') + ' * 100', 1)} AS week_rate FROM trk t LEFT JOIN mt ON mt.ym = t.ym"""


@query("excel_matrix_report", f"WITH {TRACK} {matrix_sql('sales')} UNION ALL {matrix_sql('orders')}")
def excel_matrix_report(t):
    return tg.report_matrix(tracking(t), month_targets(t), ["sales", "orders"])


@query("month_forecast_fill", f"""WITH {HEADS}, dl AS (SELECT store, sale_date, {big('sum(order_amount)')} AS sales, count(*) AS orders FROM heads WHERE ym = '2001-07' GROUP BY ALL),
  f AS (SELECT store, count(*) AS n, regr_slope(CAST(sales AS DOUBLE), day(sale_date)) AS s1, regr_intercept(CAST(sales AS DOUBLE), day(sale_date)) AS i1, regr_slope(CAST(orders AS DOUBLE), day(sale_date)) AS s2, regr_intercept(CAST(orders AS DOUBLE), day(sale_date)) AS i2 FROM dl GROUP BY store),
  g AS (SELECT s.store, CAST(d AS DATE) AS sale_date FROM stores s, generate_series(DATE '2001-07-01', DATE '2001-07-31', INTERVAL 1 DAY) x(d))
  SELECT g.store, CAST(g.sale_date AS VARCHAR) AS sale_date, CASE WHEN dl.store IS NULL THEN '예측값' ELSE '실제값' END AS kind, COALESCE(dl.sales, CASE WHEN COALESCE(n, 0) < 3 THEN 250000 ELSE greatest(CAST({rnd('s1 * day(g.sale_date) + i1', 0)} AS BIGINT), 0) END) AS sales,
    COALESCE(dl.orders, CASE WHEN COALESCE(n, 0) < 3 THEN 5 ELSE greatest(CAST({rnd('s2 * day(g.sale_date) + i2', 0)} AS BIGINT), 0) END) AS orders FROM g LEFT JOIN dl USING (store, sale_date) LEFT JOIN f ON f.store = g.store""")
def month_forecast_fill(t):
    daily = t.heads.groupBy("store", "sale_date").agg(F.sum("order_amount").alias("sales"), F.count(F.lit(1)).alias("orders"))
    return tg.month_forecast_fill(daily, t.stores, "2001-07", {"sales": 250_000, "orders": 5})
