"""Cleaning functions and business rules over text derived from the tables."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, LINE_SEQ, RAW_LINES, REVIEWS, big, query, ratio, rint, rnd
from tillbook.catalog.c02_series import CARD
from tillbook.functions import clean as c, keys, rules as r
from tillbook.plans import scores as sc
from tillbook.sources.fixtures import AS_OF, LINE_ORDER

S = lambda x: F.col(x).cast("string")
KEY = ["order_id"]


@query("coalesce_dup_columns", f"""WITH {HEADS} SELECT order_id, COALESCE(CASE WHEN source = 'F' THEN order_amount END,
  CASE WHEN source <> 'O' THEN order_amount + 1 END) AS amount FROM heads""")
def coalesce_dup_columns(t):
    wide = t.heads.select(
        "order_id", F.when(F.col("source") == "F", F.col("order_amount")).alias("amount"),
        F.when(F.col("source") != "O", F.col("order_amount") + 1).alias(" amount "),
    )
    return c.coalesce_dup_columns(wide)


@query("money_to_int", f"""WITH {HEADS} SELECT order_id, CASE source WHEN 'P' THEN 0 ELSE order_amount END AS amount FROM heads""")
def money_to_int(t):
    raw = F.when(F.col("source") == "P", F.concat(S("order_amount"), F.lit("won"))).otherwise(
        F.concat(F.lit(" "), F.format_number("order_amount", 0), F.lit(" "))
    )
    return t.heads.select("order_id", c.money_to_int(raw).alias("amount"))


@query("coerce_numeric_by_ratio", f"""WITH {HEADS} SELECT order_id, CASE WHEN source <> 'P' OR o_orderkey % 2 = 0 THEN CAST(order_amount AS DOUBLE) END AS mostly,
  CASE WHEN source = 'F' THEN CAST(order_amount AS VARCHAR) ELSE 'n/a' END AS rarely FROM heads""")
def coerce_numeric_by_ratio(t):
    good = (F.col("source") != "P") | (F.col("o_orderkey") % 2 == 0)
    df = t.heads.select(
        "order_id", F.when(good, S("order_amount")).otherwise("?").alias("mostly"),
        F.when(F.col("source") == "F", S("order_amount")).otherwise("n/a").alias("rarely"),
    )
    return c.coerce_numeric_by_ratio(df, ["mostly", "rarely"])


@query("normalize_id", f"""WITH {HEADS} SELECT order_id, CASE source WHEN 'P' THEN 'A-' || order_id ELSE order_id END AS id FROM heads""")
def normalize_id(t):
    raw = F.when(F.col("source") == "P", F.concat(F.lit("A-"), S("order_id"))).otherwise(
        F.concat(F.lit(" 000"), S("order_id"))
    )
    return t.heads.select("order_id", c.normalize_id(raw).alias("id"))


@query("normalize_time", f"""WITH {HEADS} SELECT order_id, CASE source WHEN 'F' THEN order_time WHEN 'O' THEN order_time ELSE 'none' END AS t FROM heads""")
def normalize_time(t):
    raw = (
        F.when(F.col("source") == "F", F.concat(F.lit("01:01:01 then "), "order_time"))
        .when(F.col("source") == "O", F.concat(F.lit("at "), F.substring("order_time", 1, 5)))
        .otherwise("none")
    )
    return t.heads.select("order_id", c.normalize_time(raw).alias("t"))


@query("parse_mixed_date", f"""WITH {HEADS} SELECT order_id, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(sale_date AS VARCHAR) END AS d FROM heads""")
def parse_mixed_date(t):
    k, d = F.col("o_orderkey") % 5, F.col("sale_date")
    raw = (
        F.when(k == 0, F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string"))
        .when(k == 1, F.date_format(d, "yyyy/MM/dd")).when(k == 2, F.date_format(d, "yyyy.MM.dd"))
        .when(k == 3, F.date_format(d, "yyyy-MM-dd")).otherwise("999999")
    )
    return t.heads.select("order_id", c.parse_mixed_date(raw).alias("d"))


@query("parse_localized_datetime", f"""WITH {HEADS} SELECT order_id, CASE WHEN source <> 'P' THEN CAST(sale_date AS VARCHAR) END AS d,
  CASE WHEN source <> 'P' THEN order_time END AS t FROM heads""")
def parse_localized_datetime(t):
    h = F.substring("order_time", 1, 2).cast("int")
    h12 = F.when(h % 12 == 0, 12).otherwise(h % 12)
    rest = F.substring("order_time", 3, 6)
    korean = F.concat(
        F.date_format("sale_date", "yyyy. MM. dd. "), F.lit("(월) "), F.when(h >= 12, "오후 ").otherwise("오전 "),
        h12.cast("string"), rest,
    )
    short = F.concat(F.date_format("sale_date", "yyyy.M.d "), h.cast("string"), F.substring("order_time", 3, 3))
    raw = F.when(F.col("source") == "F", korean).when(F.col("source") == "O", short).otherwise("yesterday")
    d, clock = c.parse_localized_datetime(raw)
    return t.heads.select("order_id", d.alias("d"), clock.alias("t"))


@query("parse_target_month", f"""WITH {HEADS}, a AS (SELECT order_id, o_orderkey % 4 AS k, sale_date, year(sale_date) AS y FROM heads)
  SELECT order_id, CASE k WHEN 0 THEN strftime(sale_date, '%Y-%m') WHEN 1 THEN CASE WHEN y >= 2000 THEN strftime(sale_date, '%Y-%m')
    ELSE strftime(sale_date, '%y-%b') END WHEN 2 THEN '2001-' || strftime(sale_date, '%m') ELSE 'soon' END AS ym FROM a""")
def parse_target_month(t):
    k = F.col("o_orderkey") % 4
    raw = (
        F.when(k == 0, F.date_format("sale_date", "yyyy-M")).when(k == 1, F.date_format("sale_date", "yy-MMM"))
        .when(k == 2, F.date_format("sale_date", "30-MMM").cast("string")).otherwise("soon")
    )
    return t.heads.select("order_id", c.parse_target_month(raw, AS_OF).alias("ym"))


BRANDS = ("AMERICA", "ASIA")


@query("store_alias_normalize", f"""WITH {HEADS}, a AS (SELECT order_id, CASE WHEN o_orderkey % 2 = 0 THEN 'ASIA ' || store ELSE store END AS store FROM heads),
  b AS (SELECT order_id, CASE WHEN store IN ('ASIA NATION_2', 'NATION_2') THEN 'AMERICA NEW 2' WHEN store = 'NATION_7' THEN 'ASIA NEW 7' ELSE store END AS store FROM a)
  SELECT order_id, store, replace(regexp_replace(store, '^(AMERICA|ASIA)\\s+', ''), ' ', '') AS store_key FROM b""")
def store_alias_normalize(t):
    aliases = t.stores.where(F.col("store").isin("NATION_2", "NATION_7")).select(
        F.when(F.col("store") == "NATION_2", "ASIA NATION_2").otherwise(F.col("store")).alias("old"),
        F.when(F.col("store") == "NATION_2", "AMERICA NEW 2").otherwise("ASIA NEW 7").alias("new"),
    )
    name = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("ASIA "), "store")).otherwise(F.col("store"))
    return c.store_alias_normalize(t.heads.select("order_id", name.alias("store")), aliases, "store", BRANDS)


@query("brand_branch_extract", f"""WITH {HEADS} SELECT order_id, CASE WHEN region = 'ASIA' THEN 'EAST' WHEN region IN ('AMERICA', 'EUROPE') THEN 'WEST' END AS brand,
  store AS branch FROM heads""")
def brand_branch_extract(t):
    raw = F.when(
        F.col("source") == "F", F.concat(F.lit("[tag] "), F.col("region"), F.lit(" kitchen "), "store")
    ).otherwise(F.concat(F.col("region"), F.lit("-kitchen "), "store"))
    # Store names contain '_', so blanks are made the separator by replacing it and putting it back.
    brand, branch = c.brand_branch_extract(F.replace(raw, F.lit("_"), F.lit("#")), {"EAST": ["ASIA"], "WEST": ["AMERICA", "EUROPE"]})
    return t.heads.select("order_id", brand.alias("brand"), F.replace(branch, F.lit("#"), F.lit("_")).alias("branch"))


@query("surrogate_key", f"""WITH {HEADS} SELECT order_id, substr(sha1(CAST(sale_date AS VARCHAR) || '|' || store || '|' || order_id), 1, 16) AS skey FROM heads""")
def surrogate_key(t):
    return t.heads.select("order_id", keys.surrogate_key(["sale_date", "store", "order_id"]).alias("skey"))


@query("unified_pk", f"""WITH {HEADS} SELECT l_orderkey, l_linenumber, l_partkey, md5(CAST(sale_date AS VARCHAR) || '|' || source || '|' || store || '|' || platform || '|' ||
  order_id || '|' || l_linenumber) AS pk FROM heads JOIN lineitem ON l_orderkey = o_orderkey""")
def unified_pk(t):
    return t.lines.withColumn("item_seq", F.col("l_linenumber")).select(
        "l_orderkey", "l_linenumber", "l_partkey", keys.unified_pk().alias("pk")
    )


@query("row_hash", """SELECT p_partkey, substr(md5(concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size)), 1, 12) AS h FROM part""")
def row_hash(t):
    return t.table("part").select("p_partkey", keys.row_hash(["p_partkey", "p_name", "p_brand", "p_type", "p_size"]).alias("h"))


@query("sub_order_id", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey || '_' || row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SEQ}) || '_' ||
  substr(md5(CAST(l_partkey AS VARCHAR)), 1, 4) AS sub_order_id FROM lineitem""")
def sub_order_id(t):
    rows = t.table("lineitem").withColumn("h", F.md5(S("l_partkey")))
    return keys.sub_order_id(rows, "l_orderkey", LINE_ORDER, "h").select("l_orderkey", "l_linenumber", "l_partkey", "sub_order_id")


@query("item_key_normalize", """SELECT p_partkey, regexp_replace('[' || p_brand || '] ' || p_name || ' (' || p_size || '개) 세트', '[^가-힣a-zA-Z0-9一-鿿]', '', 'g') AS item_key,
  regexp_replace(p_name || '세트', '\\s+', '', 'g') AS clean_name FROM part""")
def item_key_normalize(t):
    raw = F.concat(F.lit("["), "p_brand", F.lit("] "), "p_name", F.lit(" ("), S("p_size"), F.lit("개) 세트"))
    noisy = F.concat(F.lit("["), "p_brand", F.lit("] "), "p_name", F.lit(" 3개 증정 세트"))
    return t.table("part").select(
        "p_partkey", c.item_key(raw).alias("item_key"), c.clean_item_name(noisy, ["증정"]).alias("clean_name")
    )


@query("pure_option_extract", f"""WITH {HEADS}, a AS (SELECT order_id, store AS s, o_orderkey % 5 AS k, platform AS p FROM heads)
  SELECT order_id, CASE k WHEN 0 THEN p WHEN 1 THEN '' WHEN 2 THEN s WHEN 3 THEN p || ' | x' ELSE '' END AS option FROM a""")
def pure_option_extract(t):
    k, s, p = F.col("o_orderkey") % 5, F.col("store"), F.col("platform")
    option = (
        F.when(k == 0, F.concat(s, F.lit(" |"), p)).when(k == 1, s).when(k == 2, F.lit("None"))
        .when(k == 3, F.concat(p, F.lit("|"), s, F.lit("| x"))).otherwise(F.concat(s, F.lit("|"), s))
    )
    return t.heads.select("order_id", c.pure_option(s, option).alias("option"))


@query("strip_count_suffix", f"""WITH {HEADS} SELECT order_id, store AS menu FROM heads""")
def strip_count_suffix(t):
    k = F.col("o_orderkey") % 7
    return t.heads.select(
        "order_id", c.strip_count_suffix(F.when(k > 0, F.concat("store", F.lit(" 외 "), k, F.lit("건"))).otherwise(F.col("store"))).alias("menu")
    )


@query("memo_field_extract", f"""WITH {EVENTS} SELECT event_id, CASE WHEN k % 2 = 0 THEN event_type ELSE '' END AS issue,
  CASE k % 4 WHEN 0 THEN CAST(d AS VARCHAR) WHEN 1 THEN CAST(d AS VARCHAR) WHEN 2 THEN CAST(d AS VARCHAR) END AS memo_date,
  CASE WHEN k % 3 = 0 THEN CAST(d AS VARCHAR) WHEN k % 3 = 1 THEN CAST(date_trunc('month', d) + INTERVAL 13 DAY AS DATE)::VARCHAR END AS registered FROM ev""")
def memo_field_extract(t):
    k = F.col("k")
    memo = F.when(k % 2 == 0, F.concat(F.lit("담당: kim\n이슈유형 : "), "event_type", F.lit("\n비고: -"))).otherwise("비고: 이슈유형")
    when_ = (
        F.when(k % 4 == 0, F.concat(F.lit("처리 "), F.date_format("d", "yyyy-M-d"), F.lit(" 완료")))
        .when(k % 4 == 1, F.concat(F.lit("("), F.date_format("d", "yy.M.d"), F.lit(")")))
        .when(k % 4 == 2, F.concat(F.date_format("d", "M"), F.lit("월 "), F.date_format("d", "d"), F.lit("일 통화"))).otherwise("완료")
    )
    body = F.when(k % 3 == 1, "14일자 접수").otherwise("접수")
    reg = F.when(k % 3 == 0, F.col("d"))
    rows = t.events.withColumns({"reg": reg, "body": body, "memo": memo, "w": when_})
    return rows.select(
        "event_id", c.memo_field("memo", "이슈유형").alias("issue"), c.memo_date("w", "d").alias("memo_date"),
        c.infer_registration_date("reg", "body", "d").alias("registered"),
    )


@query("hours_text_to_minutes", f"""WITH {EVENTS}, a AS (SELECT event_id, k % 12 AS h1, (k * 7) % 24 AS h2, k % 60 AS m, d FROM ev)
  SELECT event_id, CASE WHEN h2 * 60 + m <= h1 * 60 THEN h2 * 60 + m + 1440 - h1 * 60 ELSE h2 * 60 + m - h1 * 60 END AS open_minutes,
    CAST(h2 * 60 + m + 1440 - h1 * 60 AS BIGINT) AS pause_minutes FROM a""")
def hours_text_to_minutes(t):
    h1, h2, m = F.col("k") % 12, (F.col("k") * 7) % 24, F.col("k") % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h12 = F.when(h1 == 0, 12).otherwise(h1)
    k12 = F.concat(
        F.lit("월 오전 "), h12.cast("string"), F.lit(":00 ~ (다음날) "), F.when(h2 >= 12, "오후 ").otherwise("오전 "),
        F.when(h2 % 12 == 0, 12).otherwise(h2 % 12).cast("string"), F.lit(":"), two(m),
    )
    k24 = F.concat(two(h1), F.lit(":00~"), two(h2), F.lit(":"), two(m))
    line = F.when(F.col("event_id") % 2 == 0, k12).otherwise(k24)
    pause = F.concat(
        F.date_format("d", "yy.MM.dd "), two(h1), F.lit(":00 ~ "), F.date_format(F.date_add("d", 1), "yy.MM.dd "), two(h2), F.lit(":"), two(m)
    )
    return t.events.select("event_id", c.open_minutes(line).alias("open_minutes"), c.suspension_minutes(pause).alias("pause_minutes"))


@query("date_range_explode", f"""WITH {EVENTS} SELECT event_id, CAST(CAST(x AS DATE) AS VARCHAR) AS day, CASE WHEN k % 2 = 0 THEN '1' ELSE '1,6' END AS weekdays
  FROM (SELECT event_id, k, unnest(list_distinct(generate_series(d, d + to_days(CAST(k % 4 AS INTEGER)), INTERVAL 1 DAY) || [CAST(d + 9 AS TIMESTAMP)])) AS x FROM ev)""")
def date_range_explode(t):
    k = (F.col("k") % 4).cast("int")
    span = F.concat_ws(
        ", ", F.concat_ws(" ~ ", F.date_format("d", "yyyy-MM-dd"), F.date_format(F.date_add("d", k), "yyyy-MM-dd")),
        F.date_format(F.date_add("d", 9), "yyyy-MM-dd"),
    )
    regular = F.when(F.col("k") % 2 == 0, "매주 화요일").otherwise("매주 화요일, 매주 일요일")
    return t.events.select(
        "event_id", F.explode(c.holiday_dates(span)).alias("day"),
        F.array_join(c.regular_holiday_weekdays(regular).cast("array<string>"), ",").alias("weekdays"),
    )


@query("week_start_label", f"""WITH {HEADS}, a AS (SELECT order_id, ym, CAST(date_trunc('week', sale_date) AS DATE) AS ws, CAST(ym || '-01' AS DATE) AS f FROM heads)
  SELECT order_id, CAST(ws AS VARCHAR) AS week_start, month(f) || '월' || CAST(date_diff('day', CAST(date_trunc('week', f) AS DATE), ws) // 7 + 1 AS VARCHAR) || '주차' AS label FROM a""")
def week_start_label(t):
    h = t.heads.withColumn("week_start", F.date_trunc("week", "sale_date").cast("date"))
    return h.select("order_id", "week_start", c.week_label("ym", "week_start").alias("label"))


@query("weekday_flags", f"""WITH {HEADS} SELECT order_id, strftime(sale_date, '%A') AS weekday, CASE WHEN isodow(sale_date) >= 6 THEN '주말' ELSE '평일' END AS kind FROM heads""")
def weekday_flags(t):
    from tillbook.plans.marts import weekday_flag

    return t.heads.select("order_id", F.date_format("sale_date", "EEEE").alias("weekday"), weekday_flag("sale_date").alias("kind"))


@query("period_bucket", f"""WITH {HEADS}, a AS (SELECT order_id, sale_date AS d, DATE '{AS_OF}' AS t FROM heads)
  SELECT order_id, CASE WHEN d = t THEN '금일' WHEN d = t - 1 THEN '전일' WHEN d >= date_trunc('week', t) THEN '금주'
    WHEN d >= date_trunc('week', t) - INTERVAL 7 DAY THEN '저번주' WHEN d >= date_trunc('week', t) - INTERVAL 14 DAY THEN '2주전'
    WHEN d >= date_trunc('month', t) THEN '금월' WHEN d >= date_trunc('month', t) - INTERVAL 1 MONTH THEN '전월'
    WHEN d >= date_trunc('month', t) - INTERVAL 2 MONTH THEN '2개월전' ELSE '' END AS period FROM a""")
def period_bucket(t):
    return t.heads.select("order_id", c.period_bucket("sale_date", F.lit(AS_OF).cast("date")).alias("period"))


@query("pick_first_present", f"""WITH {HEADS} SELECT order_id, CASE source WHEN 'F' THEN store WHEN 'O' THEN region ELSE platform END AS place FROM heads""")
def pick_first_present(t):
    rows = t.heads.select(
        "order_id", F.when(F.col("source") == "F", F.col("store")).otherwise("  ").alias("a"),
        F.when(F.col("source") == "O", F.col("region")).alias("b"), F.col("platform").alias("z"),
    )
    return rows.select("order_id", c.pick_first_present(rows, ["nope", "a", "b", "z"]).alias("place"))


@query("order_type_classify", f"""WITH {HEADS}, a AS (SELECT order_id, platform AS p, CASE WHEN order_type IN ('1-URGENT', '2-HIGH') THEN '포장' ELSE '홀(매장)' END AS o,
    CASE o_orderkey % 4 WHEN 0 THEN '포장2' WHEN 1 THEN CAST(o_orderkey % 30 AS VARCHAR) WHEN 2 THEN '배달-01' ELSE '' END AS t FROM heads),
  b AS (SELECT order_id, CASE WHEN p IN ('BUILDING', 'FURNITURE') AND (contains(t, '포장') OR regexp_full_match(t, '\\d+')) THEN '홀' ELSE p END AS platform,
    CASE WHEN p IN ('BUILDING', 'FURNITURE') AND contains(t, '포장') THEN '홀_포장' WHEN p IN ('BUILDING', 'FURNITURE') AND regexp_full_match(t, '\\d+') THEN '홀_테이블'
      WHEN p IN ('BUILDING', 'FURNITURE') AND contains(t, '배달') THEN '배달' ELSE o END AS o FROM a)
  SELECT order_id, platform, CASE WHEN platform = 'HOUSEHOLD' AND o = '포장' THEN '홀_포장' WHEN platform NOT IN ('BUILDING', 'FURNITURE', '홀') AND o = '포장' THEN '배달_포장'
    WHEN o IN ('홀_테이블', '홀_포장', '배달_포장', '배달') THEN o ELSE '홀_테이블' END AS order_type FROM b""")
def order_type_classify(t):
    k = F.col("o_orderkey") % 4
    table = F.when(k == 0, "포장2").when(k == 1, (F.col("o_orderkey") % 30).cast("string")).when(k == 2, "배달-01").otherwise("")
    kind = F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("홀(매장)")
    p, o = r.order_type_classify("platform", kind, table, ["BUILDING", "FURNITURE"], "HOUSEHOLD")
    return t.heads.select("order_id", p.alias("platform"), o.alias("order_type"))


@query("platform_map", f"""WITH {HEADS} SELECT order_id, CASE platform WHEN 'AUTOMOBILE' THEN 'GARAGE' WHEN 'MACHINERY' THEN 'GARAGE' ELSE platform END AS grp FROM heads""")
def platform_map(t):
    return t.heads.select("order_id", r.mapped("platform", {"AUTOMOBILE": "GARAGE", "MACHINERY": "GARAGE"}).alias("grp"))


REV = RAW_LINES + ", " + HEADS + """, rv AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, h.platform AS p, h.order_type IN ('1-URGENT', '2-HIGH') AS pack,
    CASE l_returnflag WHEN 'R' THEN true ELSE false END AS marked, list_amount AS total, CAST(round(l_tax * 100000) AS BIGINT) AS fee,
    CASE WHEN l_discount = 0 THEN list_amount ELSE discount_amount END AS discount, net_amount AS paid FROM raw_lines l JOIN heads h ON h.o_orderkey = l.l_orderkey)"""


@query("platform_revenue_rule", f"""WITH {REV} SELECT l_orderkey, l_linenumber, l_partkey, greatest(CASE
  WHEN p = 'AUTOMOBILE' THEN CASE WHEN pack THEN total - 2000 ELSE total END WHEN p = 'BUILDING' THEN paid - fee
  WHEN p = 'FURNITURE' THEN CASE WHEN total = discount THEN 0 WHEN fee > 0 THEN total - fee ELSE total END
  WHEN p = 'HOUSEHOLD' THEN CASE WHEN marked AND fee > 0 THEN total - fee ELSE total END ELSE paid END, 0) AS revenue FROM rv""")
def platform_revenue_rule(t):
    revenue = r.platform_revenue(
        "platform", F.when(F.col("order_type").isin("1-URGENT", "2-HIGH"), "포장").otherwise("배달"), "list_amount",
        F.round(F.col("l_tax") * 100000).cast("bigint"),
        F.when(F.col("l_discount") == 0, F.col("list_amount")).otherwise(F.col("discount_amount")), "net_amount",
        F.when(F.col("l_returnflag") == "R", "own rider area").otherwise(""),
        ["AUTOMOBILE"], ["BUILDING"], ["FURNITURE"], ["HOUSEHOLD"], "own rider",
    )
    return t.lines.select("l_orderkey", "l_linenumber", "l_partkey", revenue.alias("revenue"))


@query("signed_amount", f"""WITH {RAW_LINES} SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN -net_amount ELSE net_amount END AS amount FROM raw_lines""")
def signed_amount(t):
    messy = F.when(F.col("l_linenumber") % 2 == 0, -F.col("net_amount")).otherwise(F.col("net_amount"))
    return t.raw_lines.select("l_orderkey", "l_linenumber", "l_partkey", r.signed_amount(messy, F.col("l_returnflag") == "R").alias("amount"))


RATE = HEADS + f""", rt AS (SELECT order_id, order_amount, {rnd("order_amount / 2500.0", 1)} AS rate, o_orderkey % 40 AS tables, o_orderkey % 20 AS pack_share FROM heads),
  gr AS (SELECT *, CASE WHEN rate >= 100 THEN 'A' WHEN rate >= 97 THEN 'B' WHEN rate >= 93 THEN 'C' ELSE 'D' END AS grade FROM rt)"""


def graded(t):
    from tillbook.functions.numbers import rnd as rr

    h = t.heads.select(
        "order_id", "order_amount", rr(F.col("order_amount") / 2500.0, 1).alias("rate"),
        (F.col("o_orderkey") % 40).alias("tables"), (F.col("o_orderkey") % 20).alias("pack_share"),
    )
    return h.withColumn("grade", r.achievement_grade("rate"))


@query("grade_buckets", f"""WITH {RATE} SELECT order_id, rate, grade, CASE WHEN order_amount * 100 <= 10000000 THEN '1천 이하' WHEN order_amount * 100 <= 20000000 THEN '1천 초과 ~ 2천 이하'
  WHEN order_amount * 100 <= 30000000 THEN '2천 초과 ~ 3천 이하' WHEN order_amount * 100 <= 50000000 THEN '3천초과 ~ 5천 이하' ELSE '5천 초과' END AS band FROM gr""")
def grade_buckets(t):
    from tillbook.plans.daily_summary import revenue_band

    return graded(t).select("order_id", "rate", "grade", revenue_band(F.col("order_amount") * 100).alias("band"))


ST = "CASE {0} % 4 WHEN 0 THEN '정상' WHEN 1 THEN '관심' WHEN 2 THEN '주의' ELSE '위험' END"
# Every figure of the scorecard from the order's key, so that each branch is met; 'pick' leaves some of them unknown.
CARDS = HEADS + f""", k AS (SELECT o_orderkey AS k, order_id, order_amount FROM heads),
  c AS (SELECT *, k % 41 - 30.0 AS day_pct, k % 37 - 25.0 AS week_pct, CAST(k % 13 AS DOUBLE) AS orders, CASE WHEN k % 11 = 0 THEN NULL ELSE k % 17 END AS prev_orders,
    (k % 17) * 20000.0 AS prev_amount, 15000.0 + (k % 9) * 1500 AS ticket, 80.0 + k % 23 AS ma14, 95.0 + k % 7 AS ma28, {ST.format('(k // 3)')} AS fee_status, {ST.format('(k // 5)')} AS ad_a_status,
    {ST.format('(k // 7)')} AS ad_b_status, {ST.format('(k // 11)')} AS service_status, k % 43 + 0.5 AS fee_rate, k % 31 + 0.5 AS prev_fee_rate, CAST(k % 29 AS DOUBLE) AS fee_rate_a, CAST(k % 19 AS DOUBLE) AS fee_rate_b,
    CAST(k % 3 * 40 AS DOUBLE) AS ad_a_clicks, CAST(k % 2 AS DOUBLE) AS ad_a_orders, CAST(k % 5 * 20 AS DOUBLE) AS ad_b_clicks, CAST(k % 6 AS DOUBLE) AS ad_b_orders, (k % 12) * 1000.0 AS ad_spend,
    CAST(k % 33 AS DOUBLE) AS cook_minutes, (k % 101) / 100.0 AS accept_rate, (k % 103) / 100.0 AS promise_rate, (k % 47) / 100.0 AS reorder_rate, (k % 53) / 10.0 AS rating FROM k)"""


@query("rule_diagnosis", f"""WITH {CARDS}, x AS (SELECT *, fee_status IN ('주의', '위험') AS fb, ad_a_status IN ('주의', '위험') AS ab, ad_b_status IN ('주의', '위험') AS bb,
    coalesce(day_pct < -15 AND week_pct < -15, false) AS down, coalesce(prev_orders > 0 AND orders > 0, false) AS two,
    coalesce(fee_rate > 0 AND prev_fee_rate > 0 AND fee_rate - prev_fee_rate > 5, false) AS spike, coalesce(fee_rate_a > 0 AND fee_rate_b > 0 AND abs(fee_rate_a - fee_rate_b) > 10, false) AS gap FROM c),
  y AS (SELECT *, CASE WHEN NOT down THEN NULL WHEN two AND (orders / prev_orders - 1) * 100 < -15 THEN CASE WHEN fb THEN 'sales_orders_fee' WHEN ab OR bb THEN 'sales_orders_campaign' ELSE 'sales_orders_invest' END
      WHEN two AND prev_amount > 0 AND abs(ticket / (prev_amount / prev_orders) - 1) * 100 > 10 THEN 'sales_ticket' ELSE 'sales_together' END AS c1,
    CASE WHEN day_pct < -15 AND week_pct >= 0 THEN 'sales_one_day' END AS c2, CASE WHEN ma14 > 0 AND ma28 > 0 AND (ma14 / ma28 - 1) * 100 < -10 THEN 'sales_trend' END AS c3,
    CASE WHEN fb AND spike THEN 'fee_spike' WHEN fb AND gap THEN 'fee_platform' WHEN fb THEN 'fee_high' WHEN fee_rate > 33 THEN 'fee_third' END AS c4,
    CASE WHEN NOT bb THEN NULL WHEN ad_b_clicks > 0 AND ad_b_orders > 0 THEN CASE WHEN ad_b_orders / ad_b_clicks * 100 < 5 THEN 'ad_b_conversion' ELSE 'ad_b_targeting' END ELSE 'ad_b_review' END AS c5,
    CASE WHEN NOT ab THEN NULL WHEN ad_a_clicks > 0 AND ad_a_orders > 0 THEN 'ad_a_conversion' ELSE 'ad_a_review' END AS c6,
    CASE WHEN NOT (ab OR bb OR fb) AND (day_pct < -10 OR week_pct < -10) AND ad_spend > 0 AND order_amount > 0 AND ad_spend / order_amount * 100 < 7 THEN 'ad_room' END AS c7,
    CASE WHEN cook_minutes > 25 THEN 'cook_very_slow' WHEN cook_minutes > 20 THEN 'cook_slow' END AS c8, CASE WHEN accept_rate > 0 AND accept_rate < 0.95 THEN 'accept_low' END AS c9,
    CASE WHEN promise_rate > 0 AND promise_rate < 0.9 THEN 'promise_low' END AS c10, CASE WHEN reorder_rate > 0 AND reorder_rate < 0.12 THEN 'reorder_low' END AS c11,
    CASE WHEN rating > 0 AND rating < 4.3 THEN 'rating_low' END AS c12, CASE WHEN service_status IN ('주의', '위험') THEN 'service_bad' END AS c13 FROM x),
  z AS (SELECT order_id, list_filter([c1, c2, c3, c4, c5, c6, c7, c8, c9, c10, c11, c12, c13], lambda x: x IS NOT NULL) AS s FROM y)
  SELECT order_id, s[1] AS primary_code, s[2] AS secondary_code, array_to_string(s[3:], ',') AS watch_codes FROM z""")
def rule_diagnosis(t):
    k = F.col("k")
    status = lambda n: F.element_at(F.array(*(F.lit(x) for x in ("정상", "관심", "주의", "위험"))), (F.floor(k / n) % 4 + 1).cast("int"))
    cards = t.heads.select(F.col("o_orderkey").alias("k"), "order_id", F.col("order_amount").alias("amount")).select(
        "order_id", "amount", (k % 41 - 30).alias("day_pct"), (k % 37 - 25).alias("week_pct"), (k % 13).alias("orders"), F.when(k % 11 != 0, k % 17).alias("prev_orders"),
        (k % 17 * 20000).alias("prev_amount"), (15000 + k % 9 * 1500).alias("ticket"), (80 + k % 23).alias("ma14"), (95 + k % 7).alias("ma28"),
        status(3).alias("fee_status"), status(5).alias("ad_a_status"), status(7).alias("ad_b_status"), status(11).alias("service_status"),
        (k % 43 + 0.5).alias("fee_rate"), (k % 31 + 0.5).alias("prev_fee_rate"), (k % 29).alias("fee_rate_a"), (k % 19).alias("fee_rate_b"),
        (k % 3 * 40).alias("ad_a_clicks"), (k % 2).alias("ad_a_orders"), (k % 5 * 20).alias("ad_b_clicks"), (k % 6).alias("ad_b_orders"), (k % 12 * 1000).alias("ad_spend"),
        (k % 33).alias("cook_minutes"), (k % 101 / 100).alias("accept_rate"), (k % 103 / 100).alias("promise_rate"), (k % 47 / 100).alias("reorder_rate"), (k % 53 / 10).alias("rating"),
    )
    found = cards.withColumn("_codes", r.suggestions(r.four_areas(columns=cards.columns)))
    return found.withColumns(r.prioritize("_codes")).select("order_id", "primary_code", "secondary_code", "watch_codes")


@query("sales_diagnosis", f"""WITH {RATE} SELECT order_id, grade, CASE WHEN grade = 'A' THEN '목표초과' WHEN grade = 'B' THEN '목표근접'
    WHEN order_amount / 200000.0 < 0.9 AND tables < 20 THEN '유입과 구매단가 복합 문제' WHEN order_amount / 200000.0 < 0.9 THEN '객단가/메뉴구성 문제'
    WHEN pack_share < 8 THEN '포장유입 부족' ELSE '테이블수 부족' END AS diagnosis FROM gr""")
def sales_diagnosis(t):
    return graded(t).select("order_id", "grade", r.sales_diagnosis("grade", F.lit(200000), "order_amount", "tables", "pack_share").alias("diagnosis"))


CAUSE = """CASE WHEN short_score > 0 AND mid_score > 0 AND long_score > 0 AND yoy_score > 0 THEN 'broad_weakness' WHEN short_score > 0 AND mid_score > 0 THEN 'sudden_and_mid'
  WHEN mid_score > 0 AND long_score > 0 THEN 'slowing_month' WHEN long_score > 0 AND yoy_score > 0 THEN 'month_and_year' WHEN short_score > 0 THEN 'one_day'
  WHEN mid_score > 0 THEN 'two_weeks' WHEN long_score > 0 THEN 'month' WHEN yoy_score > 0 THEN 'year' ELSE 'none' END"""


@query("scorecard_diagnosis", f"""WITH {CARD}, u AS (SELECT store, 'short' AS n, short_score AS s, short_pct AS p FROM card UNION ALL SELECT store, 'mid', mid_score, mid_pct FROM card
    UNION ALL SELECT store, 'long', long_score, long_pct FROM card UNION ALL SELECT store, 'year', yoy_score, yoy_pct FROM card),
  w AS (SELECT * FROM u WHERE s > 0 AND p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store ORDER BY s DESC, p, n) <= 2),
  f AS (SELECT store, string_agg(n || ' ' || printf('%.1f', {rnd('p', 1)}), ', ' ORDER BY s DESC, p, n) AS findings FROM w GROUP BY store)
  SELECT c.store, c.grade, COALESCE(f.findings, '') AS findings, {CAUSE} AS cause FROM card c LEFT JOIN f USING (store)""")
def scorecard_diagnosis(t):
    daily = t.heads.groupBy("store", "sale_date").agg(F.sum("order_amount").alias("sales"))
    card = sc.sales_scorecard(daily, AS_OF)
    views = [("short", "short_score", "short_pct"), ("mid", "mid_score", "mid_pct"), ("long", "long_score", "long_pct"), ("year", "yoy_score", "yoy_pct")]
    return card.select(
        "store", "grade", r.scorecard_findings(views).alias("findings"),
        r.scorecard_cause("short_score", "mid_score", "long_score", "yoy_score").alias("cause"),
    )


@query("test_row_filters", f"""WITH {HEADS} SELECT order_id, platform FROM heads WHERE NOT (source = 'P' AND platform = 'BUILDING') AND NOT (store = 'NATION_3') AND order_type IN ('1-URGENT', '2-HIGH')""")
def test_row_filters(t):
    label = F.when((F.col("source") == "P") & (F.col("platform") == "BUILDING"), "합계").otherwise(F.col("platform"))
    rows = t.heads.withColumns({"label": label, "tag": F.when(F.col("store") == "NATION_3", "테스트 매장").otherwise("")})
    kept = r.drop_total_rows(rows, ["store", "label"]).where(~F.col("tag").contains("테스트"))
    return kept.where(r.any_status(["order_type", "source"], ["1-URGENT", "2-HIGH"])).select("order_id", "platform")
