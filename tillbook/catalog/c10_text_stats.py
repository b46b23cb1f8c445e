"""Labels, text rows, statistics, sorts and sets."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, LINE_SEQ, LINES, PRODUCTS, RAW_LINES, REVIEWS, big, query, ratio, rint, rnd
from tillbook.functions.numbers import rnd as num
from tillbook.operators import matching as mt, sets, statistics as st
from tillbook.plans.master import explicit_order
from tillbook.sources.fixtures import LINE_ORDER

RULES = [("METAL", ["bolt", "gear"]), ("DECOR", ["ring", "widget"])]


@query("keyword_label", """SELECT p_partkey, CASE WHEN (contains(p_name, 'blue') OR contains(p_name, 'red')) AND NOT contains(p_name, 'ring') THEN 'MAIN' WHEN contains(p_name, 'bolt') OR contains(p_name, 'gear') THEN 'METAL'
  WHEN contains(p_name, 'ring') OR contains(p_name, 'widget') THEN 'DECOR' ELSE 'OTHER' END AS label FROM part""")
def keyword_label(t):
    label = mt.keyword_label("p_name", RULES, "OTHER", "MAIN", ["blue", "red"], ["ring"])
    return t.table("part").select("p_partkey", label.alias("label"))


TOK = """tk AS (SELECT DISTINCT nm, unnest(list_distinct(list_filter(string_split_regex(lower(nm), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))) AS w FROM {0})"""


@query("token_overlap_match", f"""WITH it AS (SELECT p_partkey, p_name || ' ' || lower(p_type) AS nm FROM part WHERE p_brand <> 'Brand#1'),
  ex AS (SELECT DISTINCT p_name || ' ' || CASE WHEN p_size % 2 = 0 THEN lower(p_type) ELSE 'extra large' END AS nm, p_type AS label FROM part WHERE p_brand = 'Brand#1'),
  {TOK.format('it').replace('tk AS', 'ti AS')}, {TOK.format('ex').replace('tk AS', 'te AS')},
  ni AS (SELECT nm, count(*) AS n FROM ti GROUP BY nm), ne AS (SELECT nm, count(*) AS n FROM te GROUP BY nm),
  sh AS (SELECT ti.nm AS i, te.nm AS e, count(*) AS s FROM ti JOIN te USING (w) GROUP BY ALL),
  sc AS (SELECT sh.i, ex.label, CASE WHEN replace(sh.i, ' ', '') = replace(sh.e, ' ', '') THEN 100 ELSE CAST(100 * s // greatest(ni.n, ne.n) AS INTEGER) END AS score FROM sh JOIN ni ON ni.nm = sh.i JOIN ne ON ne.nm = sh.e JOIN ex ON ex.nm = sh.e),
  b AS (SELECT i, label, max(score) AS score FROM sc GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, label) AS rk FROM b QUALIFY rk <= 5),
  o AS (SELECT i, max(score) AS confidence, arg_min(label, rk) AS top, string_agg(label || ':' || score, ', ' ORDER BY rk) AS evidence FROM r GROUP BY i)
  SELECT it.p_partkey, it.nm, COALESCE(confidence, 0) AS confidence, CASE WHEN confidence >= 70 THEN top ELSE '' END AS matched_label, COALESCE(evidence, '') AS evidence FROM it LEFT JOIN o ON o.i = it.nm""")
def token_overlap_match(t):
    p = t.table("part")
    items = p.where(F.col("p_brand") != "Brand#1").select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_type")).alias("nm"))
    tail = F.when(F.col("p_size") % 2 == 0, F.lower("p_type")).otherwise("extra large")
    ex = p.where(F.col("p_brand") == "Brand#1").select(F.concat_ws(" ", "p_name", tail).alias("nm"), F.col("p_type").alias("label"))
    return mt.token_overlap_match(items, ex, "p_partkey", "nm")


@query("label_override_chain", """WITH o AS (SELECT CASE WHEN p_size = 1 THEN 'K' || p_partkey ELSE '' END AS item_pk, CASE WHEN p_size = 2 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS item_id, CASE WHEN p_size = 3 THEN p_name ELSE '' END AS item_name,
    CASE WHEN p_brand = 'Brand#4' THEN '미분류' ELSE p_type END AS item_type, p_partkey AS pos FROM part WHERE p_size <= 3), g AS (SELECT * FROM o WHERE item_type <> '미분류'),
  nm AS (SELECT item_name, item_type FROM g WHERE item_name <> '' QUALIFY row_number() OVER (PARTITION BY item_name ORDER BY pos DESC) = 1)
  SELECT p.p_partkey, COALESCE(a.item_type, b.item_type, nm.item_type, CASE WHEN contains(p_name, 'ring') THEN 'RING' ELSE 'OTHER' END) AS item_type, CASE WHEN COALESCE(a.item_type, b.item_type, nm.item_type) IS NULL THEN 'rule' ELSE 'manual' END AS classified_by
  FROM part p LEFT JOIN g a ON a.item_pk = 'K' || p.p_partkey LEFT JOIN g b ON b.item_id = CAST(p.p_partkey AS VARCHAR) LEFT JOIN nm ON nm.item_name = p.p_name""")
def label_override_chain(t):
    p = t.table("part")
    blank = lambda n, v: F.when(F.col("p_size") == n, v).otherwise("")
    over = p.where(F.col("p_size") <= 3).select(
        blank(1, F.concat(F.lit("K"), "p_partkey")).alias("item_pk"), blank(2, F.col("p_partkey").cast("string")).alias("item_id"), blank(3, F.col("p_name")).alias("item_name"),
        F.when(F.col("p_brand") == "Brand#4", "미분류").otherwise(F.col("p_type")).alias("item_type"), F.col("p_partkey").alias("pos"),
    )
    items = p.select("p_partkey", F.concat(F.lit("K"), "p_partkey").alias("item_pk"), F.col("p_partkey").cast("string").alias("item_id"), F.col("p_name").alias("item_name"))
    return mt.label_override_chain(items, over, F.when(F.col("item_name").contains("ring"), "RING").otherwise("OTHER")).select("p_partkey", "item_type", "classified_by")


@query("label_train_stats", """WITH c AS (SELECT p_type, p_name, count(*) AS n FROM part GROUP BY ALL), b AS (SELECT p_type, CAST(sum(n) AS BIGINT) AS rows, count(*) AS examples FROM c GROUP BY p_type),
  t AS (SELECT p_type, string_agg(p_name, ', ' ORDER BY n DESC, p_name) AS top_examples FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_name) <= 3) GROUP BY p_type)
  SELECT * FROM b JOIN t USING (p_type)""")
def label_train_stats(t):
    return mt.label_train_stats(t.table("part"), "p_type", "p_name")


@query("false_positive_rules", f"""WITH {REVIEWS}, f AS (SELECT doc_id, text, CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END AS food, CASE n_chars % 3 WHEN 0 THEN 'taste' WHEN 1 THEN 'sauce' ELSE 'missing' END AS food_detail,
    CASE WHEN n_chars % 5 < 3 THEN 1 ELSE 0 END AS sales, CASE n_chars % 4 WHEN 0 THEN 'weak' ELSE 'flat' END AS sales_detail FROM rev),
  g AS (SELECT doc_id, text, food, CASE WHEN regexp_matches(text, 'the|le ') AND food = 1 AND food_detail IN ('taste', 'sauce') THEN 'sauce quality' ELSE food_detail END AS food_detail, sales, sales_detail FROM f),
  h AS (SELECT doc_id, text, food, food_detail, CASE WHEN regexp_matches(text, 'er|un') AND sales = 1 AND sales_detail = 'weak' THEN 0 ELSE sales END AS sales, CASE WHEN regexp_matches(text, 'er|un') AND sales = 1 AND sales_detail = 'weak' THEN '해당없음' ELSE sales_detail END AS sales_detail FROM g)
  SELECT doc_id, food, food_detail, sales, sales_detail FROM h""")
def false_positive_rules(t):
    n = F.col("n_chars")
    rows = t.reviews.select(
        "doc_id", "text", F.when(n % 2 == 0, 1).otherwise(0).alias("food"), F.when(n % 3 == 0, "taste").when(n % 3 == 1, "sauce").otherwise("missing").alias("food_detail"),
        F.when(n % 5 < 3, 1).otherwise(0).alias("sales"), F.when(n % 4 == 0, "weak").otherwise("flat").alias("sales_detail"),
    )
    rules = [("the|le ", "food", "taste|sauce", "sauce quality"), ("er|un", "sales", "weak", None)]
    return mt.false_positive_rules(rows, "text", rules).drop("text")


@query("flatten_multi_label", f"""WITH {EVENTS}, i AS (SELECT event_id, 'food' AS type, k % 2 = 0 AS has, k % 3 AS p, 0 AS o FROM ev UNION ALL SELECT event_id, 'sales', k % 3 = 0, 1, 1 FROM ev UNION ALL SELECT event_id, 'ops', k % 5 = 0, 2, 2 FROM ev),
  r AS (SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY p, o) AS priority, type, 'd' || p AS detail FROM i WHERE has)
  SELECT * FROM r UNION ALL SELECT event_id, 1, '특이사항없음', '' FROM ev WHERE event_id NOT IN (SELECT event_id FROM r)""")
def flatten_multi_label(t):
    k = F.col("k")
    item = lambda name, has, p: F.struct(F.lit(name).alias("type"), has.alias("has_issue"), p.cast("int").alias("priority"), F.concat(F.lit("d"), p).alias("detail"))
    issues = F.to_json(F.array(item("food", k % 2 == 0, k % 3), item("sales", k % 3 == 0, F.lit(1)), item("ops", k % 5 == 0, F.lit(2))))
    return mt.flatten_multi_label(t.events.select("event_id", issues.alias("j")), "event_id", "j")


@query("unit_price_vote", f"""WITH {RAW_LINES}, a AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN list_amount ELSE unit_price END AS p, qty, CAST(round(p_retailprice) AS BIGINT) AS m FROM raw_lines JOIN part ON p_partkey = l_partkey)
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN m > 0 AND abs({rint('CAST(p AS DOUBLE) / CASE WHEN qty <> 0 THEN qty ELSE 1 END')} - m) < abs(p - m) THEN {rint('CAST(p AS DOUBLE) / CASE WHEN qty <> 0 THEN qty ELSE 1 END')} ELSE p END AS unit_price_each FROM a""")
def unit_price_vote(t):
    p = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.round("p_retailprice").cast("bigint").alias("m"))
    rows = t.raw_lines.join(p, "l_partkey").withColumn("p", F.when(F.col("l_linenumber") % 2 == 0, F.col("list_amount")).otherwise(F.col("unit_price")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", mt.unit_price_vote("p", "qty", "m").alias("unit_price_each"))


@query("log_error_extract", """WITH d AS (SELECT doc_id, string_split(CASE WHEN doc_id % 3 = 0 THEN replace(text, ' and ', ' Traceback ') ELSE text END, chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, len(ls) AS size, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS n FROM d),
  p AS (SELECT *, trim(line) <> '' AND NOT contains(lower(line), 'traceback') AND NOT regexp_matches(lower(line), 'received sigterm|::endgroup:|local_task_job_runner\\.py') AS plain FROM l),
  h AS (SELECT *, plain AND regexp_matches(lower(line), 'err|exc') AS named, plain AND regexp_matches(trim(line), '^[A-Z]') AS capital FROM p),
  f AS (SELECT doc_id, count(*) FILTER (named) AS error_lines, max(n) FILTER (named OR capital) AS last_line_no, arg_max(trim(line), n) FILTER (named OR capital) AS summary,
    coalesce(max(n) FILTER (contains(line, 'Traceback')), greatest(max(size) - 40, 0)) AS beg FROM h GROUP BY doc_id),
  x AS (SELECT doc_id, string_agg(rtrim(line), chr(10) ORDER BY n) AS excerpt, arg_max(trim(line), n) AS tail FROM l JOIN f USING (doc_id) WHERE n BETWEEN beg AND beg + 39 AND trim(line) <> '' GROUP BY doc_id)
  SELECT doc_id, error_lines, last_line_no, coalesce(summary, tail) AS summary, trim(excerpt) AS excerpt FROM f LEFT JOIN x USING (doc_id)""")
def log_error_extract(t):
    body = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit(" and "), F.lit(" Traceback "))).otherwise(F.col("text"))
    return mt.log_error_extract(t.table("documents").select("doc_id", body.alias("text")), "doc_id", "text", "err|exc")


# -- statistics ---------------------------------------------------------------

CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def corr_sql(a, b):
    return f"SELECT '{a}' AS x, '{b}' AS y, count(*) AS n, corr({a}, {b}) AS r FROM lineitem"


#: The tails of t beyond what is seen, by Simpson's rule over its density (gamma functions by their series, for many rows); from 40 on they are nothing.
P_SQL = """, t AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c),
  i AS (SELECT x, y, sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * power(1 + power(least(abs(t), 40) * i / 2000, 2) / (n - 2), -(n - 1) / 2.0)) * least(abs(t), 40) / 6000 AS area
    FROM t, range(0, 2001) s(i) GROUP BY x, y, t)
  SELECT t.x, t.y, n, {r} AS r, {t} AS t, {p} AS p FROM t JOIN i ON i.x = t.x AND i.y = t.y"""
P_SQL = P_SQL.format(r=rnd("r", 6), t=rnd("t", 4), p=rnd("CASE WHEN abs(t) >= 40 THEN 0 ELSE abs(1 - 2 * exp(-1 / (4.0 * (n - 2)) + 1 / (24.0 * (n - 2) * (n - 2) * (n - 2))) / sqrt(2 * pi()) * area) END", 6))


@query("correlation_test", "WITH c AS (" + " UNION ALL ".join(corr_sql(a, b) for i, a in enumerate(CORR) for b in CORR[i + 1:]) + ")" + P_SQL)
def correlation_test(t):
    return st.correlation_test(t.table("lineitem"), CORR).withColumn("p", num(F.col("p"), 6))


@query("spearman_test", f"""WITH v AS (SELECT o_totalprice AS a, c_acctbal AS b FROM orders JOIN customer ON c_custkey = o_custkey),
  r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM v),
  c AS (SELECT 'o_totalprice' AS x, 'c_acctbal' AS y, count(*) AS n, corr(ra, rb) AS r FROM r){P_SQL}""")
def spearman_test(t):
    j = t.table("orders").join(t.table("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return st.spearman_test(j, "o_totalprice", "c_acctbal").withColumn("p", num(F.col("p"), 6))


PAIRS = [("AUTOMOBILE", "BUILDING"), ("FURNITURE", "MACHINERY"), ("BUILDING", "HOUSEHOLD")]


@query("group_compare", f"""WITH g AS (SELECT c_mktsegment AS g, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
  j AS (SELECT a.g AS group_a, b.g AS group_b, a.n AS n_a, b.n AS n_b, a.m - b.m AS d, a.v / a.n AS va, b.v / b.n AS vb, ((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) AS sp FROM g a JOIN g b ON (a.g, b.g) IN ({', '.join(str(p) for p in PAIRS)}))
  SELECT group_a, group_b, n_a, n_b, {rnd('d', 4)} AS mean_diff, {rnd('d / sqrt(sp * (1.0 / n_a + 1.0 / n_b))', 4)} AS t_equal, {rnd('d / sqrt(va + vb)', 4)} AS t_welch,
    {rnd('(va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1))')} AS welch_df, {rnd('d / sqrt(sp)', 4)} AS cohen_d FROM j""")
def group_compare(t):
    j = t.table("orders").join(t.table("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return st.group_compare(j, "c_mktsegment", "o_totalprice", PAIRS)


@query("anova", f"""WITH g AS (SELECT c_mktsegment, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
  s AS (SELECT count(*) AS k, sum(n) AS n, sum(n * m) / sum(n) AS grand, sum(n * m * m) AS s2, sum((n - 1) * v) AS w FROM g), b AS (SELECT *, s2 - n * grand * grand AS b FROM s)
  SELECT k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within, {rnd('(b / (k - 1)) / (w / (n - k))', 3)} AS f, {rnd('b / (b + w)', 6)} AS eta_sq, {rnd('sqrt((b / (b + w)) / (1 - b / (b + w)))', 5)} AS cohen_f FROM b""")
def anova(t):
    j = t.table("orders").join(t.table("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return st.anova(j, "c_mktsegment", "o_totalprice")


def chi_sql(src, a, b):
    return f"""WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2), m AS (SELECT *, sum(o) OVER (PARTITION BY a) AS ra, sum(o) OVER (PARTITION BY b) AS rb, sum(o) OVER () AS n FROM c),
  e AS (SELECT *, CAST(ra AS DOUBLE) * rb / n AS e FROM m), s AS (SELECT max(n) AS n, count(DISTINCT a) AS ka, count(DISTINCT b) AS kb, sum(o * o / e) - max(n) AS chi, sum(power(greatest(abs(o - e) - 0.5, 0), 2) / e) AS y, count(*) FILTER (e < 5) AS low FROM e)
  SELECT CAST(n AS BIGINT) AS n, (ka - 1) * (kb - 1) AS df, {rnd('chi', 4)} AS chi2, CASE WHEN ka = 2 AND kb = 2 THEN {rnd('y', 4)} END AS chi2_yates, {rnd('sqrt(greatest(chi, 0) / (n * (least(ka, kb) - 1)))', 6)} AS cramer_v, low AS low_expected FROM s"""


@query("independence_test", chi_sql("orders JOIN customer ON c_custkey = o_custkey", "o_orderpriority", "c_mktsegment"))
def independence_test(t):
    j = t.table("orders").join(t.table("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return st.independence_test(j, "o_orderpriority", "c_mktsegment")


@query("independence_test_2x2", chi_sql("labels", "quality", "toxic"))
def independence_test_2x2(t):
    return st.independence_test(t.table("labels"), "quality", "toxic")


@query("simple_regression", f"""SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, {rnd('regr_slope(l_extendedprice, l_quantity)', 6)} AS slope, {rnd('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept,
  {rnd('regr_r2(l_extendedprice, l_quantity)', 6)} AS r2 FROM lineitem GROUP BY l_returnflag""")
def simple_regression(t):
    return st.simple_regression(t.table("lineitem"), "l_extendedprice", "l_quantity", ["l_returnflag"])


@query("linear_regression", f"""WITH v AS (SELECT l_extendedprice AS y, l_quantity AS a, l_discount AS b, l_quantity * l_discount AS c FROM lineitem),
  m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc FROM v),
  d AS (SELECT y - my AS y, a - ma AS a, b - mb AS b, c - mc AS c, n, ma, mb, mc, my FROM v, m),
  g AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(a * c) AS ac, sum(b * b) AS bb, sum(b * c) AS bc, sum(c * c) AS cc, sum(a * y) AS ay, sum(b * y) AS yb, sum(c * y) AS cy, sum(y * y) AS yy FROM d),
  t AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM g),
  i AS (SELECT *, (bb * cc - bc * bc) / det AS vaa, (ac * bc - ab * cc) / det AS vab, (ab * bc - ac * bb) / det AS vac, (aa * cc - ac * ac) / det AS vbb, (ab * ac - aa * bc) / det AS vbc, (aa * bb - ab * ab) / det AS vcc FROM t),
  k AS (SELECT *, vaa * ay + vab * yb + vac * cy AS ka, vab * ay + vbb * yb + vbc * cy AS kb, vac * ay + vbc * yb + vcc * cy AS kc FROM i),
  r AS (SELECT *, yy - ka * ay - kb * yb - kc * cy AS rss FROM k),
  e AS (SELECT d.y - ka * d.a - kb * d.b - kc * d.c AS e, vaa * d.a + vab * d.b + vac * d.c AS ha, vab * d.a + vbb * d.b + vbc * d.c AS hb, vac * d.a + vbc * d.b + vcc * d.c AS hc, d.a, d.b, d.c, n, ma, mb, mc FROM d, r),
  w AS (SELECT *, power(e / (1 - 1 / n - ha * a - hb * b - hc * c), 2) AS w, 1 / n - ha * ma - hb * mb - hc * mc AS h0 FROM e),
  h AS (SELECT sum(w * ha * ha) AS wa, sum(w * hb * hb) AS wb, sum(w * hc * hc) AS wc, sum(w * h0 * h0) AS w0, avg(e * e) AS e2, avg(e * e * e) AS e3, avg(e * e * e * e) AS e4 FROM w),
  f AS (SELECT *, rss / (n - 4) AS s2, 1 - rss / yy AS r2, e3 / power(e2, 1.5) AS skew, e4 / (e2 * e2) AS kurt FROM r, h, m),
  o AS (SELECT 'l_quantity' AS term, ka AS b, vaa AS v, wa AS hc3, vaa * aa AS vif, f.* FROM f UNION ALL SELECT 'l_discount', kb, vbb, wb, vbb * bb, f.* FROM f UNION ALL SELECT 'l_quantity:l_discount', kc, vcc, wc, vcc * cc, f.* FROM f
    UNION ALL SELECT '(intercept)', my - ka * ma - kb * mb - kc * mc, 1 / n + ma * ma * vaa + mb * mb * vbb + mc * mc * vcc + 2 * (ma * mb * vab + ma * mc * vac + mb * mc * vbc), w0, NULL, f.* FROM f)
  SELECT term, {rnd('b', 3)} AS coefficient, {rnd('sqrt(s2 * v)', 3)} AS std_error, {rnd('b / sqrt(s2 * v)', 3)} AS t, {rnd('sqrt(hc3)', 3)} AS std_error_hc3, {rnd('vif', 4)} AS vif, CAST(n AS BIGINT) AS n, {rnd('r2', 6)} AS r2,
    {rnd('1 - (1 - r2) * (n - 1) / (n - 4)', 6)} AS r2_adj, {rnd('r2 / 3 / ((1 - r2) / (n - 4))', 1)} AS f, {rnd('skew', 5)} AS skew, {rnd('kurt', 5)} AS kurtosis, {rnd('n / 6 * (skew * skew + (kurt - 3) * (kurt - 3) / 4)', 1)} AS jarque_bera FROM o""")
def linear_regression(t):
    found = st.regression(t.table("lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], [("l_quantity", "l_discount")])
    digits = {"coefficient": 3, "std_error": 3, "t": 3, "std_error_hc3": 3, "vif": 4, "r2": 6, "r2_adj": 6, "f": 1, "skew": 5, "kurtosis": 5, "jarque_bera": 1}
    return found.select("term", "n", *[num(F.col(c), d).alias(c) for c, d in digits.items()])


# -- sorts, limits, sets ------------------------------------------------------


@query("stable_sort_output", f"WITH {HEADS} SELECT store, CAST(sale_date AS VARCHAR) AS sale_date, {big('sum(order_amount)')} AS sales FROM heads GROUP BY store, sale_date ORDER BY store, sale_date")
def stable_sort_output(t):
    return sets.stable_sort(t.heads.groupBy("store", "sale_date").agg(F.sum("order_amount").alias("sales")), ["store", "sale_date"])


@query("explicit_order_sort", f"WITH {HEADS} SELECT platform, count(*) AS orders, CASE platform WHEN 'HOUSEHOLD' THEN 1 WHEN 'AUTOMOBILE' THEN 2 ELSE 999 END AS pos FROM heads GROUP BY platform")
def explicit_order_sort(t):
    g = t.heads.groupBy("platform").agg(F.count(F.lit(1)).alias("orders"))
    return g.withColumn("pos", explicit_order("platform", ["HOUSEHOLD", "AUTOMOBILE"])).orderBy("pos", "platform")


@query("topk_per_group", f"""WITH {HEADS}, a AS (SELECT 'top' AS side, store, order_id, order_amount, row_number() OVER (PARTITION BY store ORDER BY order_amount DESC, o_orderkey) AS rank FROM heads QUALIFY rank <= 3),
  b AS (SELECT 'low' AS side, store, order_id, order_amount, row_number() OVER (PARTITION BY store ORDER BY order_amount, o_orderkey) AS rank FROM heads QUALIFY rank <= 3) SELECT * FROM a UNION ALL SELECT * FROM b""")
def topk_per_group(t):
    cols = ["side", "store", "order_id", "order_amount", "rank"]
    a = sets.nlargest(t.heads, ["store"], "order_amount", 3, ["o_orderkey"]).withColumn("side", F.lit("top")).select(*cols)
    return a.unionByName(sets.nsmallest(t.heads, ["store"], "order_amount", 3, ["o_orderkey"]).withColumn("side", F.lit("low")).select(*cols))


@query("limit_orders", f"""WITH {LINES}, f AS (SELECT DISTINCT sale_date, o_orderkey FROM lines ORDER BY sale_date, o_orderkey LIMIT 100) SELECT order_id, l_linenumber, l_partkey, qty FROM lines WHERE o_orderkey IN (SELECT o_orderkey FROM f)""")
def limit_orders(t):
    return sets.limit_orders(t.lines, "o_orderkey", ["sale_date"], 100).select("order_id", "l_linenumber", "l_partkey", "qty")


@query("union_by_name", f"""WITH {HEADS}, {EVENTS} SELECT store, order_amount AS amount, platform, NULL AS event_type FROM heads UNION ALL SELECT store, amount, NULL, event_type FROM ev""")
def union_by_name(t):
    return sets.union_by_name([t.heads.select("store", F.col("order_amount").alias("amount"), "platform"), t.events.select("event_type", "store", "amount")])


@query("key_intersection", f"WITH {HEADS} SELECT DISTINCT store, CAST(sale_date AS VARCHAR) AS sale_date FROM heads WHERE source = 'F' AND (store, sale_date) IN (SELECT (store, sale_date) FROM heads WHERE source = 'O')")
def key_intersection(t):
    h = t.heads
    return sets.key_intersection(h.where(F.col("source") == "F"), h.where(F.col("source") == "O"), ["store", "sale_date"])


@query("key_difference", f"WITH {HEADS} SELECT DISTINCT store, CAST(sale_date AS VARCHAR) AS sale_date FROM heads WHERE source = 'F' AND (store, sale_date) NOT IN (SELECT (store, sale_date) FROM heads WHERE source <> 'F')")
def key_difference(t):
    h = t.heads
    return sets.key_difference(h.where(F.col("source") == "F"), h.where(F.col("source") != "F"), ["store", "sale_date"])


@query("linear_regression_two", f"""WITH v AS (SELECT l_extendedprice AS y, l_quantity AS a, l_discount AS b FROM lineitem),
  m AS (SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, count(*) * var_pop(a) AS aa, count(*) * var_pop(b) AS bb, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS by_, count(*) * var_pop(y) AS yy FROM v),
  c AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM m),
  r AS (SELECT *, (ca * ay + cb * by_) / yy AS r2, my - ca * ma - cb * mb AS c0, (yy - ca * ay - cb * by_) / (n - 3) AS s2 FROM c),
  o AS (SELECT 'l_quantity' AS term, ca AS coefficient, sqrt(s2 * bb / (aa * bb - ab * ab)) AS se, r2, n FROM r UNION ALL SELECT 'l_discount', cb, sqrt(s2 * aa / (aa * bb - ab * ab)), r2, n FROM r
    UNION ALL SELECT '(intercept)', c0, sqrt(s2 * (1.0 / n + (ma * ma * bb - 2 * ma * mb * ab + mb * mb * aa) / (aa * bb - ab * ab))), r2, n FROM r)
  SELECT term, {rnd('coefficient', 4)} AS coefficient, {rnd('se', 4)} AS std_error, {rnd('coefficient / se', 3)} AS t, {rnd('r2', 6)} AS r2, {rnd('1 - (1 - r2) * (n - 1) / (n - 3)', 6)} AS r2_adj FROM o""")
def linear_regression_two(t):
    found = st.linear_regression(t.table("lineitem"), "l_extendedprice", ["l_quantity", "l_discount"])
    return found.select("term", num(F.col("coefficient"), 4).alias("coefficient"), num(F.col("std_error"), 4).alias("std_error"), num(F.col("t"), 3).alias("t"), num(F.col("r2"), 6).alias("r2"), num(F.col("r2_adj"), 6).alias("r2_adj"))
