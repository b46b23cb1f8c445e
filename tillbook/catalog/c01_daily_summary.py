"""Daily summary family."""

from tillbook.catalog.base import LINES, big, query, ratio, rint, rnd, tint
from tillbook.plans import daily_summary as ds
from tillbook.sources.fixtures import AS_OF

ASOF_YM = AS_OF[:7]

DAILY = LINES + """, daily AS (
  SELECT sale_date, ym, store, brand, order_type, platform, min(region) AS region, min(manager) AS manager,
         min(open_date) AS open_date, CAST(sum(total_price) AS BIGINT) AS total_price,
         CAST(sum(order_cnt) AS BIGINT) AS order_cnt
  FROM lines GROUP BY sale_date, ym, store, brand, order_type, platform)"""
MONTHLY = DAILY + f""", m0 AS (
  SELECT ym, store, brand, order_type, platform, {big('sum(total_price)')} AS month_sales,
         {big('sum(order_cnt)')} AS month_order_cnt, count(DISTINCT sale_date) AS actual_days,
         max(sale_date) AS max_sale_date
  FROM lines GROUP BY ALL), monthly AS (
  SELECT *, {rnd(ratio('month_sales', 'actual_days'))} AS avg_daily_sales,
         {rnd(ratio('month_order_cnt', 'actual_days'))} AS avg_daily_order_cnt FROM m0)"""
EXPECTED = MONTHLY + f""", expected AS (
  SELECT *, CASE WHEN ym < '{ASOF_YM}' THEN month_sales WHEN ym = '{ASOF_YM}'
              THEN {rint('avg_daily_sales * day(last_day(max_sale_date))')} ELSE 0 END AS expected_month_sales,
         CASE WHEN ym < '{ASOF_YM}' THEN month_order_cnt WHEN ym = '{ASOF_YM}'
              THEN {rint('avg_daily_order_cnt * day(last_day(max_sale_date))')} ELSE 0 END AS expected_month_order_cnt
  FROM monthly)"""
LAGGED = EXPECTED + f""", lagged AS (
  SELECT *, COALESCE(lag(expected_month_sales) OVER w, 0) AS prev_expected_month_sales,
         COALESCE(lag(month_order_cnt) OVER w, 0) AS prev_month_order_cnt,
         {rint('avg(expected_month_sales) OVER w3')} AS avg_3m_expected_sales,
         {rint('avg(expected_month_order_cnt) OVER w3')} AS avg_3m_order_cnt
  FROM expected
  WINDOW w AS (PARTITION BY store, brand, order_type, platform ORDER BY ym),
         w3 AS (PARTITION BY store, brand, order_type, platform ORDER BY ym ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""
WEEKLY = LAGGED + f""", w0 AS (
  SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, store, brand, order_type, platform,
         {big('sum(total_price)')} AS week_sales, {big('sum(order_cnt)')} AS week_order_cnt,
         count(DISTINCT sale_date) AS days_cnt
  FROM lines GROUP BY ALL), w1 AS (
  SELECT *, {rnd(ratio('week_sales', 'days_cnt'))} AS avg_dw, {rnd(ratio('week_order_cnt', 'days_cnt'))} AS avg_dw_o
  FROM w0), w2 AS (
  SELECT *, CASE WHEN week_start < date_trunc('week', DATE '{AS_OF}') THEN week_sales
              WHEN week_start = date_trunc('week', DATE '{AS_OF}') THEN {rint('avg_dw * 7')} ELSE 0 END AS expected_week_sales,
         CASE WHEN week_start < date_trunc('week', DATE '{AS_OF}') THEN week_order_cnt
              WHEN week_start = date_trunc('week', DATE '{AS_OF}') THEN {rint('avg_dw_o * 7')} ELSE 0 END AS expected_week_order_cnt
  FROM w1), weekly AS (
  SELECT *, COALESCE(lag(expected_week_sales) OVER w, 0) AS prev_expected_week_sales,
         COALESCE(lag(week_order_cnt) OVER w, 0) AS prev_week_order_cnt,
         {tint('avg(expected_week_sales) OVER w3')} AS avg_3w_expected_sales,
         {tint('avg(expected_week_order_cnt) OVER w3')} AS avg_3w_order_cnt
  FROM w2
  WINDOW w AS (PARTITION BY store, brand, order_type, platform ORDER BY week_start),
         w3 AS (PARTITION BY store, brand, order_type, platform ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""
BAND = """CASE WHEN {0} <= 10000000 THEN '1천 이하' WHEN {0} <= 20000000 THEN '1천 초과 ~ 2천 이하'
  WHEN {0} <= 30000000 THEN '2천 초과 ~ 3천 이하' WHEN {0} <= 50000000 THEN '3천초과 ~ 5천 이하' ELSE '5천 초과' END"""
STORE = WEEKLY + f""", s0 AS (
  SELECT store, brand, ym, {big('sum(total_price)')} AS tp, {big('sum(order_cnt)')} AS oc,
         count(DISTINCT sale_date) AS actual_days, max(sale_date) AS ms
  FROM lines GROUP BY ALL), s1 AS (
  SELECT *, {rint(ratio('tp', 'actual_days'))} AS avg_day_sales, {rnd(ratio('oc', 'actual_days'))} AS avg_day_orders
  FROM s0), s2 AS (
  SELECT *, CASE WHEN ym < '{ASOF_YM}' THEN tp WHEN ym = '{ASOF_YM}' THEN avg_day_sales * day(last_day(ms)) ELSE 0 END AS expected_sales,
         CASE WHEN ym < '{ASOF_YM}' THEN oc WHEN ym = '{ASOF_YM}' THEN {rint('avg_day_orders * day(last_day(ms))')} ELSE 0 END AS expected_orders
  FROM s1), store_exp AS (
  SELECT a.*, COALESCE(b.expected_sales, 0) AS prev_expected_sales, COALESCE(b.oc, 0) AS prev_orders,
         {tint('avg(a.expected_sales) OVER w3')} AS avg3_sales, {tint('avg(a.expected_orders) OVER w3')} AS avg3_orders,
         COALESCE(lag(a.avg_day_sales) OVER w, 0) AS prev_day_sales
  FROM s2 a LEFT JOIN s2 b ON a.store = b.store AND a.brand = b.brand
    AND b.ym = strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
  WINDOW w AS (PARTITION BY a.store, a.brand ORDER BY a.ym),
         w3 AS (PARTITION BY a.store, a.brand ORDER BY a.ym ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)), band AS (
  SELECT store, {BAND.format('sum(expected_sales)')} AS band FROM s2 WHERE ym = '{ASOF_YM}' GROUP BY store), store_month AS (
  SELECT e.ym, e.store, e.brand, e.expected_sales AS store_expected_month_sales,
         e.expected_orders AS store_expected_month_order_cnt, e.prev_expected_sales AS store_prev_expected_month_sales,
         e.prev_orders AS store_prev_expected_month_order_cnt,
         COALESCE(b.band, {BAND.format('e.expected_sales')}) AS status
  FROM store_exp e LEFT JOIN band b ON e.store = b.store)"""


@query("daily_channel_summary", f"""WITH {DAILY} SELECT CAST(sale_date AS VARCHAR) AS sale_date, ym, store, brand, order_type,
  platform, region, manager, CAST(open_date AS VARCHAR) AS open_date, total_price, order_cnt FROM daily""")
def daily_channel_summary(t):
    return ds.daily_channel(t.lines)


@query("monthly_channel", f"WITH {MONTHLY} SELECT * REPLACE (CAST(max_sale_date AS VARCHAR) AS max_sale_date) FROM monthly")
def monthly_channel(t):
    return ds.monthly_channel(ds.daily_channel(t.lines))


@query("expected_month", f"WITH {EXPECTED} SELECT * REPLACE (CAST(max_sale_date AS VARCHAR) AS max_sale_date) FROM expected")
def expected_month(t):
    return ds.expected_month(ds.monthly_channel(ds.daily_channel(t.lines)), AS_OF)


@query("prev_month_lag", f"""WITH {LAGGED} SELECT ym, store, brand, order_type, platform, expected_month_sales,
  prev_expected_month_sales, prev_month_order_cnt FROM lagged""")
def prev_month_lag(t):
    return ds.prev_month_lag(ds.expected_month(ds.monthly_channel(ds.daily_channel(t.lines)), AS_OF)).select(
        "ym", *ds.CHANNEL, "expected_month_sales", "prev_expected_month_sales", "prev_month_order_cnt"
    )


@query("avg_prev_3", f"""WITH {LAGGED} SELECT ym, store, brand, order_type, platform, expected_month_sales,
  avg_3m_expected_sales, avg_3m_order_cnt FROM lagged""")
def avg_prev_3(t):
    return ds.avg_prev_3(ds.expected_month(ds.monthly_channel(ds.daily_channel(t.lines)), AS_OF)).select(
        "ym", *ds.CHANNEL, "expected_month_sales", "avg_3m_expected_sales", "avg_3m_order_cnt"
    )


@query("weekly_channel", f"WITH {WEEKLY} SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM weekly")
def weekly_channel(t):
    return ds.weekly_channel(ds.daily_channel(t.lines), AS_OF)


@query("next_month_join", f"""WITH {STORE} SELECT store, brand, ym, tp, oc, actual_days, avg_day_sales, avg_day_orders,
  expected_sales, expected_orders, prev_expected_sales, prev_orders, avg3_sales, avg3_orders, prev_day_sales FROM store_exp""")
def next_month_join(t):
    return ds.store_expected(ds.daily_channel(t.lines), AS_OF)


@query("store_month_rollup", f"WITH {STORE} SELECT * FROM store_month")
def store_month_rollup(t):
    return ds.store_month_rollup(ds.daily_channel(t.lines), AS_OF)


@query("daily_summary", f"""WITH {STORE}, store_week AS (
  SELECT week_start, store, brand, {big('sum(expected_week_sales)')} AS store_expected_week_sales,
         {big('sum(expected_week_order_cnt)')} AS store_expected_week_order_cnt
  FROM weekly GROUP BY week_start, store, brand)
SELECT CAST(d.sale_date AS VARCHAR) AS sale_date, d.ym, d.store, d.brand, d.order_type, d.platform, d.region, d.manager,
  CAST(d.open_date AS VARCHAR) AS open_date, d.total_price, d.order_cnt, CAST(w.week_start AS VARCHAR) AS week_start,
  CASE WHEN d.ym < '{ASOF_YM}' THEN d.total_price ELSE m.expected_month_sales END AS expected_month_sales,
  CASE WHEN d.ym < '{ASOF_YM}' THEN d.order_cnt ELSE m.expected_month_order_cnt END AS expected_month_order_cnt,
  m.prev_expected_month_sales, m.avg_3m_expected_sales, m.prev_month_order_cnt, m.avg_3m_order_cnt,
  s.store_expected_month_sales, s.store_expected_month_order_cnt, s.store_prev_expected_month_sales,
  s.store_prev_expected_month_order_cnt, s.status, w.expected_week_sales, w.expected_week_order_cnt,
  w.prev_expected_week_sales, w.avg_3w_expected_sales, w.prev_week_order_cnt, w.avg_3w_order_cnt,
  sw.store_expected_week_sales, sw.store_expected_week_order_cnt
FROM daily d
JOIN lagged m USING (ym, store, brand, order_type, platform)
JOIN store_month s USING (ym, store, brand)
JOIN weekly w ON w.week_start = date_trunc('week', d.sale_date) AND w.store = d.store AND w.brand = d.brand
  AND w.order_type = d.order_type AND w.platform = d.platform
JOIN store_week sw ON sw.week_start = w.week_start AND sw.store = d.store AND sw.brand = d.brand""")
def daily_summary(t):
    return ds.daily_summary(t.lines, AS_OF)
