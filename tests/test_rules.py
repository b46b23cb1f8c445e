"""Edge rules on small literal tables: nulls, ties, zero denominators, half-even, gaps, refunds, idempotence."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillbook.functions import clean as c, numbers as n, rules as r
from tillbook.operators import joins as j, matching as mt, order_lines as o, series as s, sets
from tillbook.operators.core import keep_one
from tillbook.plans import marts, scores as sc, targets as tg
from tillbook.session import fresh_path
from tillbook.sources import writers as wr


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in zip(cols, ["string"] * len(cols)))) if cols else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_half_even_and_zero_denominators(spark):
    row = spark.range(1).select(
        n.rnd(F.lit(0.125), 2).alias("a"), n.rnd(F.lit(0.375), 2).alias("b"), n.rnd_int(F.lit(2.5)).alias("c"), n.rnd_int(F.lit(3.5)).alias("d"),
        n.ratio(F.lit(1), F.lit(0)).alias("e"), n.pct(F.lit(5), F.lit(0)).alias("f"), n.rnd_int(F.lit(None).cast("double")).alias("g"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, row.g) == (0.12, 0.38, 2, 4, None, None, 0)


def test_text_cleaning(spark):
    assert one(spark, c.money_to_int("t"), t=" 1,234 ") == 1234
    assert one(spark, c.money_to_int("t"), t="n/a") == 0
    assert one(spark, c.normalize_id("t"), t="0001") == "1"
    assert one(spark, c.normalize_id("t"), t="A01") == "A01"
    assert one(spark, c.normalize_time("t"), t="x 10:11:12 y 13:14:15") == "13:14:15"
    assert one(spark, c.parse_mixed_date("t"), t="45000") == date(2023, 3, 15)
    assert one(spark, c.parse_mixed_date("t"), t="2150-01-01") is None
    d, clock = c.parse_localized_datetime("t")
    assert one(spark, clock, t="2026. 06. 15. (월) 오전 12:05:04") == "00:05:04"
    assert one(spark, d, t="2026. 06. 15. (월) 오후 10:48:04") == date(2026, 6, 15)
    assert one(spark, c.open_minutes("t"), t="월 오후 10:00 ~ 오전 2:30") == 270
    assert one(spark, F.size(c.holiday_dates("t")), t="2026-05-27 ~ 2026-05-29, 2026-05-28") == 3
    assert one(spark, c.parse_target_month("t", "2026-06-01"), t="26-Apr") == "2026-04"
    assert one(spark, c.parse_target_month("t", "2026-06-01"), t="01-May") == "2026-05"


def test_score_limits(spark):
    rows = spark.createDataFrame([(90, 100), (91, 100), (100, 100), (5, 0), (None, 100)], "now int, base int")
    assert [x.s for x in rows.select(sc.sales_drop_score("now", "base").alias("s")).collect()] == [2, 1, 0, 0, 0]


def test_row_and_calendar_windows_differ_on_gaps(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, d), d) for d in (1, 2, 5)], "k string, d date, v int")
    out = {x.d.day: (x.prev, x.lag) for x in rows.select("d", s.shifted("v", "k", "d", 1).alias("prev"), F.lag("v").over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("k").orderBy("d")).alias("lag")).collect()}
    assert out == {1: (None, None), 2: (1, 1), 5: (None, 2)}


def test_rolling_needs_enough_values(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, d), None if d == 2 else d) for d in range(1, 6)], "k string, d date, v int")
    got = [x.m for x in rows.select("d", s.rolling(F.avg, "v", "k", "d", -2, 0, 2).alias("m")).orderBy("d").collect()]
    assert got == [None, None, 2.0, 3.5, 4.0]


def lines(spark, rows):
    return spark.createDataFrame(rows, "order_id string, item_seq int, item_name string, price int, qty int, opt int, amount int")


def test_remainder_allocation_sums_exactly(spark):
    df = lines(spark, [("o1", 1, "a", 100, 1, 0, 1000), ("o1", 2, "x", None, 1, 30, 1000), ("o1", 3, "y", None, 1, 60, 1000), ("o1", 4, "b", 200, 1, 0, 1000),
                       ("o2", 1, "a", None, 1, 0, 77), ("o3", 1, "a", 0, 1, 0, 5), ("o3", 2, "b", 0, 1, 0, 5)])
    g = o.menu_group_segments(df, ["order_id"], "price", hot=None)
    out = o.remainder_allocation(g, ["order_id"], "menu_group", "price", "qty", "opt", "amount", "part", hot=None)
    got = {(x.order_id, x.item_seq): x.part for x in out.collect()}
    assert got == {("o1", 1): 0, ("o1", 2): 111, ("o1", 3): 222, ("o1", 4): 667, ("o2", 1): 77, ("o3", 1): 0, ("o3", 2): 5}


def test_segments_fall_back(spark):
    df = lines(spark, [("m", 1, "fee 배달비", 3000, 1, 0, 0), ("m", 2, "soup", 9000, 1, 0, 0), ("m", 3, "rice", 1000, 1, 0, 0), ("m", 4, "stew", 8000, 1, 0, 0), ("n", 1, None, 0, 1, 0, 0)])
    got = {(x.order_id, x.item_seq): x.menu_name for x in o.main_item_segments(df, ["order_id"], F.lit(False), "price", F.lit(False), hot=None).collect()}
    assert got == {("m", 1): "soup", ("m", 2): "soup", ("m", 3): "soup", ("m", 4): "stew", ("n", 1): None}


def test_adjustment_balances_refund(spark):
    df = spark.createDataFrame([("r", 1, "i", "n", 1, 10, -10, 0, "취소", -1, -12), ("s", 1, "i", "n", 1, 10, 10, 0, "정상", 1, 10)],
                               "order_id string, item_seq int, item_id string, item_name string, qty int, unit_price int, total_price int, discount_amount int, sale_type string, order_cnt int, head int")
    out = o.adjustment_rows(df, ["order_id"], "head", hot=None)
    adj = out.where(F.col("item_id") == o.ADJUST_ID).collect()
    assert [(x.order_id, x.total_price, x.sale_type, x.item_seq) for x in adj] == [("r", -2, "취소", 2)]
    assert out.count() == 3


def test_left_joins_keep_rows(spark):
    facts = spark.createDataFrame([(1, "B X S1"), (2, "X S1"), (3, "S1"), (4, "none"), (5, None)], "id int, name string")
    dim = spark.createDataFrame([("B X S1", "m1"), ("C X S1", "m2")], "full string, manager string")
    got = {x.id: (x.match_stage, x.manager) for x in j.cascading_match(facts, dim, "name", "full", ["manager"]).collect()}
    assert got == {1: (1, "m1"), 2: (2, "m1"), 3: (3, "m1"), 4: (None, None), 5: (None, None)}


def test_nearest_prefers_earlier_on_ties(spark):
    q = spark.createDataFrame([("s", date(2024, 1, 9), 1), ("s", date(2024, 1, 11), 2), ("s", date(2024, 2, 10), 3)], "site string, base_date date, price int")
    out = j.nearest_asof(q, q, "site", F.add_months("base_date", -1), 7, "p").where("price = 3").first()
    assert out.p == 1


def test_keep_one_order(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", 2, 2), ("a", 2, 3)], "k string, t int, v int")
    assert keep_one(rows, ["k"], [F.col("t").desc_nulls_last(), "v"]).first().v == 2


def test_weekly_target_counts_days_inside_the_month(spark):
    out = tg.weekly_target_split(spark.createDataFrame([("2024-02", 2900)], "ym string, sales int"), ["sales"])
    got = {str(x.week_start): (x.days, x.sales_target) for x in out.collect()}
    assert got["2024-01-29"] == (4, 400) and got["2024-02-26"] == (4, 400) and sum(d for d, _ in got.values()) == 29


def test_cs_mart_keeps_last_known_value(spark):
    rows = spark.createDataFrame(
        [("300", date(2024, 1, 1), date(2024, 1, 2), "접수", "a", ""), ("300", date(2024, 1, 3), date(2024, 1, 4), "완료", None, "memo"), ("", date(2024, 1, 1), date(2024, 1, 1), "완료", "z", "")],
        "ticket string, registered date, collected date, status string, issue string, memo string",
    ).withColumn("uploaded_at", F.col("collected").cast("timestamp"))
    x = marts.cs_issue_mart(rows, ["issue"], "2024-02-01", 215).collect()
    assert [(r_.ticket, r_.issue, r_.is_done, r_.duration_days) for r_ in x] == [("300", "a", 1, 3)]


def test_flatten_orders_by_priority(spark):
    df = spark.createDataFrame([(1, '[{"type":"b","has_issue":true,"priority":3,"detail":"x"},{"type":"a","has_issue":true,"priority":1,"detail":"y"}]'), (2, "[]")], "id int, j string")
    got = [(x.id, x.priority, x.type) for x in mt.flatten_multi_label(df, "id", "j").orderBy("id", "priority").collect()]
    assert got == [(1, 1, "a"), (1, 2, "b"), (2, 1, "특이사항없음")]


def test_upsert_is_idempotent_and_keeps_other_partitions(spark):
    path = fresh_path(spark, "t")
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, p string, v int")
    wr.write_table(old, path, ["p"])
    new = spark.createDataFrame([(1, "a", 11), (3, "a", 30)], "id int, p string, v int")
    for _ in range(2):
        wr.upsert(spark, path, new, ["id"], ["p"], ["id"])
        got = sorted((x.id, x.p, x.v) for x in wr.read_table(spark, path, old).collect())
        assert got == [(1, "a", 11), (2, "b", 20), (3, "a", 30)]
    assert wr.same_keys(new, new, "id") and not wr.same_keys(old, new, "id")


def test_append_unique_counts(spark):
    path = fresh_path(spark, "t")
    old = spark.createDataFrame([(1, 10)], "id int, v int")
    wr.write_table(old, path)
    x = wr.append_unique(spark, path, spark.createDataFrame([(1, 99), (2, 20)], "id int, v int"), ["id"]).first()
    assert (x.inserted, x.duplicated, x.total) == (1, 1, 2)
    assert sorted((y.id, y.v) for y in wr.read_table(spark, path, old).collect()) == [(1, 10), (2, 20)]


def test_revenue_rules(spark):
    df = spark.createDataFrame([("D", "포장", 1500, 0, 0, 100, ""), ("K", "배달", 1000, 300, 1000, 1, ""), ("K", "배달", 1000, 300, 5, 1, ""), ("Z", "x", 5, 5, 5, -3, "")],
                               "path string, kind string, total int, fee int, disc int, paid int, addr string")
    rev = r.platform_revenue("path", "kind", "total", "fee", "disc", "paid", "addr", ["D"], [], ["K"], [], "mark")
    assert [x.v for x in df.select(rev.alias("v")).collect()] == [0, 0, 700, 0]


def test_missing_source_columns_union(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert sorted(map(str, sets.union_by_name([a, b]).collect())) == ["Row(x=1, y=None)", "Row(x=None, y='q')"]


def test_agg_generic_names_missing_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        marts.agg_generic(spark.createDataFrame([(1,)], "x int"), ["x"], {"nope": "sum"})
