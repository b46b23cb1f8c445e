"""Daily series windows and scores."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, LINES, SERIES, big, pct, query, ratio, rint, rnd, tint
from tillbook.operators import series as s
from tillbook.plans import marts, scores as sc
from tillbook.sources.fixtures import AS_OF

D = "CAST(sale_date AS VARCHAR) AS sale_date"

# Limits and labels of the definition, written out for the oracles.
RISK_BANDS = ((5, "위험"), (3, "주의"), (2, "관심"))
SERVICE_BANDS = ((15, "위험"), (10, "주의"), (5, "관심"))
GRADE_BANDS = ((5, "위험"), (3, "경고"), (1, "주의"))
MEASURES = (("cook_time", "up", 2), ("accept_time", "up", 2), ("reorder_rate", "down", 4), ("stars", "down", 2))


def over(key, day, a, b=0):
    end = "CURRENT ROW" if b == 0 else f"{-b} PRECEDING"
    return f"OVER (PARTITION BY {key} ORDER BY {day} ROWS BETWEEN {-a} PRECEDING AND {end})"


def roll(fn, v, key, day, a, b=0, need=1):
    w = over(key, day, a, b)
    return f"CASE WHEN count({v}) {w} >= {need} THEN {fn}({v}) {w} END"


def month_run(fn, v, key, day):
    return (
        f"{fn}({v}) OVER (PARTITION BY {key}, strftime({day}, '%Y-%m') ORDER BY {day} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def drop_score(now, base):
    c = ratio(f"({now} - {base})", base)
    return f"CASE WHEN {c} IS NULL OR {c} >= 0 THEN 0 WHEN {c} > CAST(-0.1 AS DOUBLE) THEN 1 ELSE 2 END"


def move_score(now, base, bad):
    c = ratio(f"({now} - {base})", base)
    c = c if bad == "up" else f"(-{c})"
    return f"CASE WHEN {c} > CAST(0.1 AS DOUBLE) THEN 2 WHEN {c} > 0 THEN 1 ELSE 0 END"


def band(score, limits):
    return "CASE " + " ".join(f"WHEN {score} >= {n} THEN '{l}'" for n, l in limits) + " ELSE '정상' END"


def prev_same_day(table, value, key, day):
    """Left join condition for the same day of the previous month."""
    return (
        f"LEFT JOIN {table} pm ON pm.{key} = a.{key} AND day(pm.{day}) = day(a.{day}) AND "
        f"date_trunc('month', pm.{day}) = date_trunc('month', a.{day}) - INTERVAL 1 MONTH"
    )


@query("rolling_sums", f"""WITH {SERIES} SELECT {D}, store, manager, total_amount, settlement_amount, total_order_count,
  {tint(roll('sum', 'total_amount', 'store', 'sale_date', -6))} AS sum_7d_recent,
  {tint(roll('sum', 'total_amount', 'store', 'sale_date', -13, -7))} AS sum_7d_prev,
  {tint(roll('sum', 'total_amount', 'store', 'sale_date', -29))} AS sum_30d_recent,
  {tint(roll('sum', 'total_amount', 'store', 'sale_date', -59, -30))} AS sum_30d_prev FROM series""")
def rolling_sums(t):
    return s.rolling_sums(t.series, "store")


MA = f"""{rnd(roll('avg', 'total_amount', 'store', 'sale_date', -13, 0, 7))} AS ma_14,
  {rnd(roll('avg', 'total_amount', 'store', 'sale_date', -27, 0, 14))} AS ma_28"""


@query("moving_average", f"WITH {SERIES} SELECT {D}, store, total_amount, {MA} FROM series")
def moving_average(t):
    return s.moving_average(t.series.select("sale_date", "store", "total_amount"), "store")


MTD = SERIES + f""", mtd AS (SELECT *, {tint(month_run('sum', 'total_amount', 'store', 'sale_date'))} AS amt_curr_mtd FROM series)"""


@query("mtd_cumsum", f"""WITH {MTD} SELECT CAST(a.sale_date AS VARCHAR) AS sale_date, a.store, a.total_amount, a.amt_curr_mtd,
  COALESCE(pm.amt_curr_mtd, 0) AS amt_prev_mtd FROM mtd a {prev_same_day('mtd', 'amt_curr_mtd', 'store', 'sale_date')}""")
def mtd_cumsum(t):
    return s.mtd_cumsum(t.series.select("sale_date", "store", "total_amount"), "store")


@query("mtd_expanding_mean", f"""WITH {SERIES} SELECT {D}, store, total_amount,
  {rnd(month_run('avg', 'total_amount', 'store', 'sale_date'))} AS mtd_mean FROM series""")
def mtd_expanding_mean(t):
    return s.mtd_expanding_mean(t.series.select("sale_date", "store", "total_amount"), "store")


MANAGER = LINES + f""", md AS (
  SELECT sale_date, manager, {big('sum(total_price)')} AS total_amount,
         {big("sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END)")} AS settlement_amount,
         count(DISTINCT store) AS store_count, string_agg(DISTINCT platform, ',' ORDER BY platform) AS platform,
         count(DISTINCT order_id) AS total_order_count
  FROM lines GROUP BY sale_date, manager)"""


def manager_lines(t):
    settle = F.when(F.col("l_returnflag") == "R", -F.col("settle_amount")).otherwise(F.col("settle_amount"))
    return t.lines.withColumn("settlement_amount", settle)


@query("manager_daily", f"""WITH {MANAGER} SELECT {D}, manager, total_amount, settlement_amount, store_count, platform,
  total_order_count, {rint(ratio('total_amount', 'total_order_count'))} AS arpu FROM md""")
def manager_daily(t):
    return marts.manager_daily(manager_lines(t))


@query("same_weekday_lags", f"""WITH {MANAGER} SELECT {D}, manager, total_amount, """ + ", ".join(
    f"COALESCE(lag(total_amount, {i}) OVER (PARTITION BY manager, isodow(sale_date) ORDER BY sale_date), 0) AS prev_{i}w_same_day"
    for i in range(1, 5)) + " FROM md")
def same_weekday_lags(t):
    return s.same_weekday_lags(marts.manager_daily(manager_lines(t)).select("sale_date", "manager", "total_amount"), "manager")


CAL = f"""COALESCE(pd.total_amount, 0) AS prev_day, COALESCE(pw.total_amount, 0) AS prev_week_day,
  COALESCE(pw.total_order_count, 0) AS prev_week_orders, COALESCE(pmt.amt, 0) AS prev_month_total,
  {pct('a.total_amount', 'COALESCE(pd.total_amount, 0)')} AS vs_prev_day_pct,
  {pct('a.total_amount', 'COALESCE(pw.total_amount, 0)')} AS vs_prev_week_day_pct,
  {pct('a.total_amount', 'COALESCE(pmt.amt, 0)')} AS vs_prev_month_pct"""
CAL_JOINS = """LEFT JOIN series pd ON pd.store = a.store AND pd.sale_date = a.sale_date - INTERVAL 1 DAY
  LEFT JOIN series pw ON pw.store = a.store AND pw.sale_date = a.sale_date - INTERVAL 7 DAY
  LEFT JOIN month_tot pmt ON pmt.store = a.store AND pmt.m = date_trunc('month', a.sale_date) - INTERVAL 1 MONTH"""
MONTH_TOT = f""", month_tot AS (SELECT store, date_trunc('month', sale_date) AS m, {big('sum(total_amount)')} AS amt
  FROM series GROUP BY ALL), week_tot AS (SELECT store, date_trunc('week', sale_date) AS w, {big('sum(total_amount)')} AS amt
  FROM series GROUP BY ALL)"""


@query("calendar_shift_join", f"""WITH {SERIES} {MONTH_TOT} SELECT CAST(a.sale_date AS VARCHAR) AS sale_date, a.store, a.manager,
  a.total_amount, a.settlement_amount, a.total_order_count, {CAL}, COALESCE(pwt.amt, 0) AS prev_week_total
  FROM series a {CAL_JOINS}
  LEFT JOIN week_tot pwt ON pwt.store = a.store AND pwt.w = date_trunc('week', a.sale_date) - INTERVAL 7 DAY""")
def calendar_shift_join(t):
    return s.calendar_comparisons(t.series, "store")


SCORED = MTD + f""", sc0 AS (SELECT a.*, COALESCE(pm.amt_curr_mtd, 0) AS amt_prev_mtd
  FROM mtd a {prev_same_day('mtd', 'amt_curr_mtd', 'store', 'sale_date')}), sc1 AS (
  SELECT *, {MA}, {tint(roll('sum', 'total_amount', 'store', 'sale_date', -6))} AS sum_7d_recent,
    {tint(roll('sum', 'total_amount', 'store', 'sale_date', -13, -7))} AS sum_7d_prev FROM sc0), sc2 AS (
  SELECT *, {drop_score('ma_14', 'ma_28')} AS score_trend, {drop_score('sum_7d_recent', 'sum_7d_prev')} AS score_7d_total,
    {drop_score('amt_curr_mtd', 'amt_prev_mtd')} AS score_4week_total FROM sc1), sc3 AS (
  SELECT *, score_trend + score_7d_total + score_4week_total AS score FROM sc2), sc4 AS (
  SELECT *, {band('score', RISK_BANDS)} AS status FROM sc3), scored AS (
  SELECT *, COALESCE(lag(status, 7) OVER (PARTITION BY store, manager ORDER BY sale_date), '정상') AS pre_status FROM sc4)"""


@query("status_lag7", f"WITH {SCORED} SELECT {D}, store, status, pre_status FROM scored")
def status_lag7(t):
    return sc.store_risk_score(t.series).select("sale_date", "store", "status", "pre_status")


@query("store_risk_score", f"""WITH {SCORED} {MONTH_TOT} SELECT a.* REPLACE (CAST(a.sale_date AS VARCHAR) AS sale_date), {CAL}
  FROM scored a {CAL_JOINS}""")
def store_risk_score(t):
    return sc.store_risk_score(t.series)


MSC = MANAGER + f""", m1 AS (SELECT *, {rint(ratio('total_amount', 'total_order_count'))} AS arpu,
    {tint(month_run('sum', 'total_amount', 'manager', 'sale_date'))} AS amt_curr_mtd,
    {rnd(roll('avg', 'total_amount', 'manager', 'sale_date', -13, 0, 7))} AS ma_14,
    {rnd(roll('avg', 'total_amount', 'manager', 'sale_date', -27, 0, 14))} AS ma_28,
    {tint(roll('sum', 'total_amount', 'manager', 'sale_date', -6))} AS sum_7d_recent,
    {tint(roll('sum', 'total_amount', 'manager', 'sale_date', -13, -7))} AS sum_7d_prev,
    """ + ", ".join(
    f"COALESCE(lag(total_amount, {i}) OVER (PARTITION BY manager, isodow(sale_date) ORDER BY sale_date), 0) AS prev_{i}w_same_day"
    for i in range(1, 5)) + f""",
    {tint("sum(total_amount) OVER (PARTITION BY manager, date_trunc('week', sale_date) ORDER BY sale_date ROWS UNBOUNDED PRECEDING)")} AS wtd,
    {tint("sum(total_amount) OVER (PARTITION BY manager, date_trunc('month', sale_date) ORDER BY sale_date ROWS UNBOUNDED PRECEDING)")} AS mtd
  FROM md), m2 AS (SELECT a.*, COALESCE(pm.amt_curr_mtd, 0) AS amt_prev_mtd FROM m1 a {prev_same_day('m1', 'amt_curr_mtd', 'manager', 'sale_date')}),
  m3 AS (SELECT *, {drop_score('ma_14', 'ma_28')} AS score_trend, {drop_score('total_amount', 'prev_1w_same_day')} AS score_total,
    {drop_score('sum_7d_recent', 'sum_7d_prev')} AS score_7d_total, {drop_score('amt_curr_mtd', 'amt_prev_mtd')} AS score_4week_total FROM m2),
  m4 AS (SELECT *, score_trend + score_7d_total + score_4week_total AS score FROM m3),
  m5 AS (SELECT *, {band('score', RISK_BANDS)} AS status FROM m4),
  m6 AS (SELECT *, COALESCE(lag(status, 7) OVER (PARTITION BY manager ORDER BY sale_date), '정상') AS pre_status FROM m5),
  wt AS (SELECT manager, date_trunc('week', sale_date) AS w, {big('sum(total_amount)')} AS amt, {big('sum(settlement_amount)')} AS st FROM md GROUP BY ALL),
  mt AS (SELECT manager, date_trunc('month', sale_date) AS m, {big('sum(total_amount)')} AS amt, {big('sum(settlement_amount)')} AS st FROM md GROUP BY ALL),
  m7 AS (SELECT a.*, COALESCE(pd.total_amount, 0) AS prev_day, COALESCE(pd.settlement_amount, 0) AS prev_day_settle,
    COALESCE(pw.total_amount, 0) AS prev_week_day, COALESCE(wt.amt, 0) AS prev_week_total, COALESCE(wt.st, 0) AS prev_week_settle,
    COALESCE(mt.amt, 0) AS prev_month_total, COALESCE(mt.st, 0) AS prev_month_settle
  FROM m6 a LEFT JOIN md pd ON pd.manager = a.manager AND pd.sale_date = a.sale_date - INTERVAL 1 DAY
  LEFT JOIN md pw ON pw.manager = a.manager AND pw.sale_date = a.sale_date - INTERVAL 7 DAY
  LEFT JOIN wt ON wt.manager = a.manager AND wt.w = date_trunc('week', a.sale_date) - INTERVAL 7 DAY
  LEFT JOIN mt ON mt.manager = a.manager AND mt.m = date_trunc('month', a.sale_date) - INTERVAL 1 MONTH)"""
WTD_COLS = f"""wtd - prev_week_total AS week_change, {pct('wtd', 'prev_week_total')} AS week_change_pct,
  mtd - prev_month_total AS month_change, {pct('mtd', 'prev_month_total')} AS month_change_pct"""


@query("wtd_mtd_vs_prev_total", f"""WITH {MSC} SELECT {D}, manager, total_amount, wtd, mtd, prev_week_total, prev_month_total,
  {WTD_COLS} FROM m7""")
def wtd_mtd_vs_prev_total(t):
    return s.wtd_mtd_vs_prev_total(
        marts.manager_daily(manager_lines(t)).select("sale_date", "manager", "total_amount"), "manager"
    )


@query("manager_risk_score", f"""WITH {MSC} SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), {WTD_COLS},
  total_amount - prev_day AS vs_prev_day, {pct('total_amount', 'prev_day')} AS vs_prev_day_pct,
  total_amount - prev_week_day AS vs_prev_week_day, {pct('total_amount', 'prev_week_day')} AS vs_prev_week_day_pct,
  {pct('settlement_amount', 'prev_day_settle')} AS settle_vs_prev_day_pct,
  {pct('settlement_amount', 'prev_week_settle')} AS settle_vs_prev_week_pct,
  {pct('settlement_amount', 'prev_month_settle')} AS settle_vs_prev_month_pct FROM m7""")
def manager_risk_score(t):
    return sc.manager_risk_score(marts.manager_daily(manager_lines(t)))


def ratio_sql(src, name, value, mtd, bad, key, day, digits):
    """CTE chain with the three scores of one measure, ending in a table named {name}_s."""
    n = name
    return f""", {n}_a AS (SELECT *, {rnd(roll('avg', value, key, day, -13, 0, 7), digits)} AS {n}_ma14,
    {rnd(roll('avg', value, key, day, -27, 0, 14), digits)} AS {n}_ma28, {rnd(roll('avg', value, key, day, -6), digits)} AS {n}_7d,
    {rnd(roll('avg', value, key, day, -13, -7), digits)} AS {n}_7d_prev, {rnd(mtd, digits)} AS {n}_mtd FROM {src}),
  {n}_b AS (SELECT a.*, COALESCE(pm.{n}_mtd, 0.0) AS {n}_mtd_prev FROM {n}_a a {prev_same_day(n + '_a', '', key, day)}),
  {n}_c AS (SELECT *, {move_score(n + '_ma14', n + '_ma28', bad)} AS {n}_trend_score,
    {move_score(n + '_7d', n + '_7d_prev', bad)} AS {n}_week_score, {move_score(n + '_mtd', n + '_mtd_prev', bad)} AS {n}_month_score FROM {n}_b),
  {n}_s AS (SELECT *, {n}_trend_score + {n}_week_score + {n}_month_score AS {n}_score FROM {n}_c)"""


def lagged_status(src, col, key, day, out):
    return f"COALESCE(lag({col}, 7) OVER (PARTITION BY {key} ORDER BY {day}), '정상') AS {out}"


FEE_MTD = f"""CASE WHEN {month_run('sum', 'total_amount', 'store', 'sale_date')} > 0 THEN
  {ratio(month_run('sum', '(total_amount - settlement_amount)', 'store', 'sale_date'), month_run('sum', 'total_amount', 'store', 'sale_date'))} END"""
FEE = SERIES + f""", fee0 AS (SELECT *, {rnd("CASE WHEN total_amount > 0 THEN " + ratio('(total_amount - settlement_amount)', 'total_amount') + " END", 4)} AS fee_ratio
  FROM series) {ratio_sql('fee0', 'fee', 'fee_ratio', FEE_MTD, 'up', 'store', 'sale_date', 4)},
  fee_t AS (SELECT *, {band('fee_score', RISK_BANDS)} AS fee_status FROM fee_s)"""


@query("fee_ratio_score", f"""WITH {FEE} SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date),
  {lagged_status('fee_t', 'fee_status', 'store', 'sale_date', 'pre_fee_status')} FROM fee_t""")
def fee_ratio_score(t):
    return sc.fee_ratio_score(t.series)


ADS = EVENTS + """, ads AS (SELECT d, store, count(*) FILTER (event_type = 'view') AS shown,
  count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS bought FROM ev GROUP BY d, store)"""


def ads(t):
    n = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    return t.events.groupBy("d", "store").agg(
        n("view").alias("shown"), n("click").alias("clicks"), n("purchase").alias("bought")
    )


def ad_sql(name, clicks, shown):
    mtd = f"""CASE WHEN {month_run('sum', shown, 'store', 'd')} > 0 THEN
      {ratio(month_run('sum', clicks, 'store', 'd'), month_run('sum', shown, 'store', 'd'))} END"""
    return f""", {name}_0 AS (SELECT *, {rnd(ratio(clicks, shown), 4)} AS {name} FROM {{src}})
      {ratio_sql(name + '_0', name, name, mtd, 'down', 'store', 'd', 4)},
      {name}_t AS (SELECT *, {band(name + '_score', RISK_BANDS)} AS {name}_status FROM {name}_s),
      {name}_u AS (SELECT *, {lagged_status('', name + '_status', 'store', 'd', 'pre_' + name + '_status')} FROM {name}_t)"""


@query("ad_effect_score", f"""WITH {ADS} {ad_sql('ctr', 'clicks', 'shown').format(src='ads')}
  {ad_sql('cvr', 'bought', 'clicks').format(src='ctr_u')} SELECT * REPLACE (CAST(d AS VARCHAR) AS d) FROM cvr_u""")
def ad_effect_score(t):
    one = sc.ad_effect_score(ads(t), "clicks", "shown", "ctr")
    return sc.ad_effect_score(one, "bought", "clicks", "cvr")


SERVICE = EVENTS + ", svc AS (SELECT d, store, " + ", ".join(
    f"{rnd(f'avg(amount) FILTER (event_type = {chr(39)}{e}{chr(39)}) / 100.0', g)} AS {m}"
    for (m, _, g), e in zip(MEASURES, ("view", "click", "purchase", "signup"))) + " FROM ev GROUP BY d, store)"


def service(t):
    from tillbook.functions.numbers import rnd as r

    kinds = zip(MEASURES, ("view", "click", "purchase", "signup"))
    return t.events.groupBy("d", "store").agg(
        *[r(F.avg(F.when(F.col("event_type") == e, F.col("amount"))) / 100.0, g).alias(m) for (m, _, g), e in kinds]
    )


def service_sql():
    out, src = "", "svc"
    for n, bad, g in MEASURES:
        out += ratio_sql(src, n, n, month_run("avg", n, "store", "d"), bad, "store", "d", g)
        src = f"{n}_s"
    total = " + ".join(f"{n}_score" for n, _, _ in MEASURES)
    return out + f""", svc_t AS (SELECT *, {total} AS service_score_total FROM {src}),
      svc_u AS (SELECT *, {band('service_score_total', SERVICE_BANDS)} AS service_status FROM svc_t)"""


@query("service_score", f"""WITH {SERVICE} {service_sql()} SELECT * REPLACE (CAST(d AS VARCHAR) AS d),
  {lagged_status('', 'service_status', 'store', 'd', 'pre_service_status')} FROM svc_u""")
def service_score(t):
    return sc.service_score(service(t))


PARTS = ("BUILDING", "MACHINERY")
PER_PLATFORM = SERIES + ", pser AS (SELECT sale_date, store, " + big("sum(total_price)") + " AS total_amount, " + big(
    "sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END)") + " AS settlement_amount, " + ", ".join(
    f"""{big(f"COALESCE(sum(total_price) FILTER (platform = '{p}'), 0)")} AS total_amount_{p},
    {big(f"COALESCE(sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END) FILTER (platform = '{p}'), 0)")} AS settlement_amount_{p}"""
    for p in PARTS) + " FROM lines GROUP BY sale_date, store)"


def cmp_sql():
    cols, final = [], []
    for p in ["", *[f"_{x}" for x in PARTS]]:
        tot, st = f"total_amount{p}", f"settlement_amount{p}"
        cols.append(f"""{rnd(ratio(f'(a.{tot} - a.{st})', f'a.{tot}') + ' * 100')} AS fee_rate{p}, pd.{tot} AS prev_day{p},
          pw.{tot} AS prev_week_day{p}, {rnd(ratio(f'(pd.{tot} - pd.{st})', f'pd.{tot}') + ' * 100')} AS prev_day_fee_rate{p},
          {rnd(ratio(f'(pw.{tot} - pw.{st})', f'pw.{tot}') + ' * 100')} AS prev_week_fee_rate{p},
          {pct(f'a.{tot}', f'pd.{tot}')} AS vs_prev_day_pct{p}, {pct(f'a.{tot}', f'pw.{tot}')} AS vs_prev_week_pct{p}""")
        final.append(f"""{rnd(f'fee_rate{p} - prev_day_fee_rate{p}')} AS fee_vs_prev_day{p},
          {rnd(f'fee_rate{p} - prev_week_fee_rate{p}')} AS fee_vs_prev_week{p}""")
    return f""", cmp AS (SELECT a.*, {', '.join(cols)} FROM pser a
      LEFT JOIN pser pd ON pd.store = a.store AND pd.sale_date = a.sale_date - INTERVAL 1 DAY
      LEFT JOIN pser pw ON pw.store = a.store AND pw.sale_date = a.sale_date - INTERVAL 7 DAY)
      SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), {', '.join(final)} FROM cmp"""


@query("period_comparison", f"WITH {PER_PLATFORM} {cmp_sql()}")
def period_comparison(t):
    settle = F.when(F.col("l_returnflag") == "R", -F.col("settle_amount")).otherwise(F.col("settle_amount"))
    pick = lambda p, v: F.coalesce(F.sum(F.when(F.col("platform") == p, v)), F.lit(0))
    g = t.lines.groupBy("sale_date", "store").agg(
        F.sum("total_price").alias("total_amount"), F.sum(settle).alias("settlement_amount"),
        *[pick(p, F.col("total_price")).alias(f"total_amount_{p}") for p in PARTS],
        *[pick(p, settle).alias(f"settlement_amount_{p}") for p in PARTS],
    )
    return sc.period_comparison(g, parts=PARTS)


def card_sql():
    t = f"DATE '{AS_OF}'"
    m0 = f"date_trunc('month', {t})"
    p0, y0 = f"({m0} - INTERVAL 1 MONTH)", f"({m0} - INTERVAL 12 MONTH)"

    def tot(lo, hi):
        return f"{big(f'COALESCE(sum(sales) FILTER (sale_date BETWEEN {lo} AND {hi}), 0)')}"

    el = f"CAST(day({t}) - 1 AS INTEGER)"

    def chg(now, base):
        return f"CASE WHEN {base} > 0 THEN ({ratio(now, base)} - 1) * 100 END"

    def fall(p, mild, steep):
        return f"CASE WHEN {p} <= -{steep} THEN 2 WHEN {p} <= -{mild} THEN 1 ELSE 0 END"

    return f""", dsum AS (SELECT store, sale_date, {big('sum(order_amount)')} AS sales FROM heads GROUP BY ALL),
    k0 AS (SELECT store, {tot(t, t)} AS today_sales,
      {rint("avg(sales) FILTER (sale_date IN (" + ", ".join(f"CAST({t} - INTERVAL {7*w} DAY AS DATE)" for w in range(1, 5)) + "))")} AS short_base_avg,
      {tot(f'{t} - INTERVAL 13 DAY', t)} AS mid_recent14, {tot(f'{t} - INTERVAL 27 DAY', f'{t} - INTERVAL 14 DAY')} AS mid_prev14,
      {tot(m0, t)} AS mtd_curr, {tot(p0, f'{p0} + to_days({el})')} AS long_prev_mtd, {tot(p0, f'last_day({p0})')} AS prev_month_total,
      {tot(y0, f'{y0} + to_days({el})')} AS yoy_prev_mtd
    FROM dsum WHERE sale_date BETWEEN {y0} AND {t} GROUP BY store),
    k1 AS (SELECT *, {rint(ratio('mtd_curr', f'day({t})'))} AS mtd_avg, {rint(ratio('prev_month_total', f'day(last_day({p0}))'))} AS prev_month_avg,
      {chg('today_sales', 'short_base_avg')} AS short_pct, {chg('mid_recent14', 'mid_prev14')} AS mid_pct,
      {chg('mtd_curr', 'long_prev_mtd')} AS long_pct, {chg('mtd_curr', 'yoy_prev_mtd')} AS yoy_pct FROM k0),
    k2 AS (SELECT *, {rnd(chg('mtd_avg', 'prev_month_avg'), 4)} AS mtd_avg_vs_prev_pct, {fall('short_pct', 5, 10)} AS short_score,
      {fall('mid_pct', 3, 7)} AS mid_score, {fall('long_pct', 3, 7)} AS long_score, {fall('yoy_pct', 5, 10)} AS yoy_score FROM k1),
    k3 AS (SELECT *, short_score + mid_score + long_score + yoy_score AS total_score FROM k2),
    card AS (SELECT * REPLACE ({rnd('short_pct', 4)} AS short_pct, {rnd('mid_pct', 4)} AS mid_pct, {rnd('long_pct', 4)} AS long_pct,
      {rnd('yoy_pct', 4)} AS yoy_pct), {band('total_score', GRADE_BANDS)} AS grade FROM k3)"""


CARD = HEADS + card_sql()


@query("sales_scorecard", f"WITH {CARD} SELECT * FROM card")
def sales_scorecard(t):
    daily = t.heads.groupBy("store", "sale_date").agg(F.sum("order_amount").alias("sales"))
    return sc.sales_scorecard(daily, AS_OF)


@query("mtd_avg_trend", f"""WITH {HEADS}, tot AS (SELECT sale_date, {big('sum(order_amount)')} AS sales FROM heads
    WHERE sale_date <= DATE '{AS_OF}' GROUP BY sale_date),
  run AS (SELECT sale_date, {big("sum(sales) OVER (PARTITION BY strftime(sale_date, '%Y-%m') ORDER BY sale_date)")} AS total_sales FROM tot),
  av AS (SELECT *, CAST(day(sale_date) AS BIGINT) AS day_count, {rint(ratio('total_sales', 'day(sale_date)'))} AS avg_sales FROM run),
  tail AS (SELECT * FROM av ORDER BY sale_date DESC LIMIT 30)
  SELECT {D}, total_sales, day_count, avg_sales,
    {rnd('(' + ratio('avg_sales', 'lag(avg_sales) OVER (ORDER BY sale_date)') + ' - 1) * 100', 4)} AS growth_pct FROM tail""")
def mtd_avg_trend(t):
    totals = t.heads.groupBy("sale_date").agg(F.sum("order_amount").alias("sales"))
    return s.mtd_avg_trend(totals, AS_OF, 30)


QUOTES = HEADS + f""", quotes AS (SELECT platform AS site, sale_date AS base_date, {rint('avg(order_amount)')} AS price,
  max(o_orderkey) AS collected_at FROM heads GROUP BY platform, sale_date)"""


def quotes(t):
    from tillbook.functions.numbers import rnd_int

    return t.heads.groupBy(F.col("platform").alias("site"), F.col("sale_date").alias("base_date")).agg(
        rnd_int(F.avg("order_amount")).alias("price"), F.max("o_orderkey").alias("collected_at")
    )


@query("price_ma", f"""WITH {QUOTES}, b AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY base_date DESC) AS n FROM quotes)
  SELECT site, CAST(max(base_date) AS VARCHAR) AS base_date, max(price) FILTER (n = 1) AS price, """ + ", ".join(
    f"CASE WHEN count(*) FILTER (n <= {k}) >= {k} THEN {rnd(f'avg(price) FILTER (n <= {k})')} END AS ma{k}" for k in (20, 60, 120))
    + " FROM b GROUP BY site")
def price_ma(t):
    return s.price_ma(quotes(t))


@query("cumulative_tracking", f"""WITH {HEADS}, dl AS (SELECT store, ym, sale_date, {big('sum(order_amount)')} AS sales, count(*) AS orders,
    {big("COALESCE(sum(order_amount) FILTER (CAST(substr(order_time, 1, 2) AS INTEGER) < 16), 0)")} AS lunch_sales,
    count(*) FILTER (CAST(substr(order_time, 1, 2) AS INTEGER) < 16) AS lunch_orders FROM heads GROUP BY ALL),
  c AS (SELECT *, count(*) OVER w AS elapsed, {big('sum(sales) OVER w')} AS cum_sales, {big('sum(orders) OVER w')} AS cum_orders,
    {big('sum(lunch_sales) OVER w')} AS cum_lunch_sales, {big('sum(lunch_orders) OVER w')} AS cum_lunch_orders FROM dl
    WINDOW w AS (PARTITION BY store, ym ORDER BY sale_date))
  SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date), COALESCE({rnd(ratio('cum_sales', 'cum_orders'))}, 0.0) AS cum_ticket,
    COALESCE({rnd(ratio('cum_lunch_sales', 'cum_lunch_orders'))}, 0.0) AS cum_lunch_ticket,
    {rnd(ratio('cum_orders', 'elapsed'), 1)} AS orders_per_day FROM c""")
def cumulative_tracking(t):
    lunch = F.substring("order_time", 1, 2).cast("int") < 16
    daily = t.heads.groupBy("store", "ym", "sale_date").agg(
        F.sum("order_amount").alias("sales"), F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum(F.when(lunch, F.col("order_amount"))), F.lit(0)).alias("lunch_sales"),
        F.count(F.when(lunch, 1)).alias("lunch_orders"),
    )
    return s.cumulative_tracking(
        daily, ["store", "ym"], "sale_date", ["sales", "orders", "lunch_sales", "lunch_orders"],
        {"cum_ticket": ("sales", "orders"), "cum_lunch_ticket": ("lunch_sales", "lunch_orders")}, ["orders"],
    )


@query("latest_complete_date", f"""WITH {HEADS}, c AS (SELECT sale_date, count(*) AS n FROM heads GROUP BY sale_date),
  l AS (SELECT greatest(quantile_cont(n, 0.5) * 0.5, 10) AS need, max(sale_date) AS latest FROM c)
  SELECT CAST(COALESCE((SELECT max(sale_date) FROM c WHERE n >= (SELECT need FROM l)), (SELECT latest FROM l)) AS VARCHAR) AS target_date""")
def latest_complete_date(t):
    return sc.latest_complete_date(t.heads, "sale_date")


@query("consecutive_risk_alert", f"""WITH {SCORED}, fee AS (WITH {FEE} SELECT sale_date, store, fee_status,
    {lagged_status('fee_t', 'fee_status', 'store', 'sale_date', 'pre_fee_status')} FROM fee_t)
  SELECT CAST(s.sale_date AS VARCHAR) AS sale_date, s.store, s.status, s.pre_status, f.fee_status, f.pre_fee_status
  FROM scored s JOIN fee f USING (sale_date, store)
  WHERE (s.status = '위험' AND s.pre_status = '위험') OR (f.fee_status = '위험' AND f.pre_fee_status = '위험')""")
def consecutive_risk_alert(t):
    # One series feeds both scores, so they are columns of one plan, not a join.
    scored = sc.fee_ratio_score(sc.store_risk_score(t.series))
    return scored.where(sc.consecutive_risk(scored.columns)).select("sale_date", "store", "status", "pre_status", "fee_status", "pre_fee_status")


@query("max_score_per_group", f"""WITH {SCORED} SELECT {D}, store, manager, score FROM scored
  QUALIFY score = max(score) OVER (PARTITION BY manager)""")
def max_score_per_group(t):
    return sc.max_score_per_group(
        sc.store_risk_score(t.series).select("sale_date", "store", "manager", "score"), "manager", "score"
    )


@query("sales_band_alerts", f"""WITH {SCORED}, fee AS (WITH {FEE} SELECT sale_date, store, fee_status,
    {lagged_status('fee_t', 'fee_status', 'store', 'sale_date', 'pre_fee_status')} FROM fee_t),
  dt AS (SELECT sale_date, count(*) AS n FROM scored GROUP BY sale_date),
  lim AS (SELECT greatest(quantile_cont(n, 0.5) * 0.5, 10) AS need, max(sale_date) AS latest FROM dt),
  tgt AS (SELECT COALESCE((SELECT max(sale_date) FROM dt WHERE n >= (SELECT need FROM lim)), (SELECT latest FROM lim)) AS td),
  day AS (SELECT s.*, f.fee_status, f.pre_fee_status FROM scored s JOIN fee f USING (sale_date, store), tgt WHERE s.sale_date >= tgt.td - 400
    AND ((s.status = '위험' AND s.pre_status = '위험') OR (f.fee_status = '위험' AND f.pre_fee_status = '위험'))),
  best AS (SELECT * FROM day QUALIFY score = max(score) OVER (PARTITION BY manager, sale_date))
  SELECT CAST(b.sale_date AS VARCHAR) AS sale_date, b.store, COALESCE(st.manager, b.manager, '미배정') AS manager, b.score, b.status,
    b.pre_status, b.fee_status, b.total_amount FROM best b LEFT JOIN stores st ON st.store = b.store""")
def sales_band_alerts(t):
    # The alerts of the last 400 days; a job that alerts for the report day takes days=0.
    scored = sc.fee_ratio_score(sc.store_risk_score(t.series))
    alerts = sc.risk_alerts(scored, "sale_date", "manager", "score", days=400)
    from tillbook.operators.joins import manager_refresh_join

    return manager_refresh_join(
        alerts.select("sale_date", "store", "manager", "score", "status", "pre_status", "fee_status", "total_amount"),
        t.stores.select("store", "manager"), "store", "manager",
    )
