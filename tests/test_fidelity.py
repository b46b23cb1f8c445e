"""Literal cases of single rules, written down from their definition."""

import io
import os
import time
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tillbook.functions import clean as c, rules as r
from tillbook.operators import joins as j, statistics as st
from tillbook.plans import reconcile as rc, scores as sc
from tillbook.session import fresh_path, remove_run, run_dir
from tillbook.sources import readers as rd, writers as wr
from tillbook.streaming.ingest import ingest_files


def test_counts_leave_out_blank_order_ids(spark):
    rows = spark.createDataFrame([("k", "B1", 3000), ("k", "", None), ("k", None, None), ("m", "A1", 10000), ("m", "A1", None), ("m", "A2", 5000)], "key string, id string, paid int")
    want = spark.createDataFrame([("k", 1, 3000), ("m", 2, 15000), ("zero", 0, 0), ("bad", 0, 7)], "key string, expected_count int, expected_amount int")
    got = {x.key: (x.actual_count, x.matched) for x in rc.count_amount_check(rows, want, ["key"], "id", ["paid"]).collect()}
    assert got == {"k": (1, 1), "m": (2, 1), "zero": (0, 1), "bad": (0, 0)}
    none = rc.count_amount_check(rows, want.limit(0), ["key"], "id", ["paid"]).collect()
    assert all(x.matched is None for x in none)


def test_last_line_of_a_weekday_wins_and_an_all_day_line_ends_the_reading(spark):
    texts = [(1, "월 10:00~22:00\n월 11:00~15:00\n화 09:00~10:00"), (2, "월 10:00~22:00\n매일 11:00~15:00\n화 09:00~10:00"), (3, "휴무"), (4, None)]
    got = {}
    for x in c.hours_by_weekday(spark.createDataFrame(texts, "id int, t string"), ["id"], "t").collect():
        got.setdefault(x.id, {})[x.weekday] = x.minutes
    assert got == {1: {0: 240, 1: 60}, 2: dict.fromkeys(range(7), 240)}


def test_alerts_need_the_worst_status_twice_in_one_area(spark):
    pairs = [x for p in sc.STATUS_PAIRS for x in p]
    normal, worst = "정상", "위험"
    rows = [tuple([i] + [worst if k in (2 * i, 2 * i + 1) else normal for k in range(10)]) for i in range(5)]
    rows += [(10, worst, normal, normal, worst, *[normal] * 6), (11, *["주의"] * 10), (12, *[None] * 10)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{p} string" for p in pairs))
    assert sorted(x.id for x in df.where(sc.consecutive_risk(df.columns)).collect()) == [0, 1, 2, 3, 4]
    alone = df.drop("pre_status")
    assert 10 in {x.id for x in alone.where(sc.consecutive_risk(alone.columns)).collect()}


def test_every_branch_of_the_four_areas_is_met(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["rule_diagnosis"](spark, "/root/testdata/sf0.01").collect()
    seen = {x for row in rows for x in [row.primary_code, row.secondary_code, *row.watch_codes.split(",")] if x}
    assert seen == {code for code, _ in r.four_areas()}


def test_review_reasons(spark):
    rows = [("a", "메인", 2, None, None), ("", "", 0, None, "llm"), ("a", "기타", 1, None, "llm"), ("a", "음료", 3, None, "llm"), ("a", "1인", 1, "", ""), ("", "x", 5, "y", "llm")]
    df = spark.createDataFrame(rows, "n string, l string, m int, ok string, by string")
    got = [x[0] for x in df.select(r.review_reasons("n", "l", "m", "ok", "by")).collect()]
    assert got == ["부모메뉴 후보 다수", "표준명 미입력, 수동분류 미입력", "기타 분류 확인", "LLM 분류 확인", "", ""]


# -- storage ------------------------------------------------------------------


def test_upsert_keeps_the_rows_of_null_and_blank_partitions(spark):
    path = fresh_path(spark, "t")
    old = spark.createDataFrame([(1, None, 10), (2, "a", 20), (3, None, 30)], "id int, ym string, v int")
    wr.write_table(old, path, ["ym"])
    wr.upsert(spark, path, spark.createDataFrame([(1, None, 11), (4, "", 40)], old.schema), ["id"], ["ym"], ["v"])
    got = sorted((x.id, x.ym, x.v) for x in wr.read_table(spark, path, old).collect())
    assert got == [(1, None, 11), (2, "a", 20), (3, None, 30), (4, None, 40)]


def test_replace_by_key_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, None, 1), (2, "x", 2)], "a int, b string, v int")
    got = sorted(x.v for x in wr.replace_by_key(old, spark.createDataFrame([(1, None, 9)], old.schema), ["a", "b"]).collect())
    assert got == [2, 9]


def test_corrections_and_late_rows_reach_the_table(spark):
    root, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "stream"))
    df = spark.createDataFrame([("o1", "2024-03-01", 1), ("o2", "2024-03-02", 2)], "id string, d string, v int")
    wr.write_table(df.limit(0), target, ["d"])
    for n, rows in enumerate(([("o1", "2024-03-01", 1), ("o2", "2024-03-02", 2)], [("o1", "2024-03-01", 99)], [("o0", "2023-01-01", 5)])):
        wr.write_table(spark.createDataFrame(rows, df.schema), f"{root}/{n}")
        ingest_files(spark, root, df.schema, target, ["id"], ["d"], lambda s: s, ["v"], checkpoint)
    assert sorted((x.id, x.v) for x in wr.read_table(spark, target, df).collect()) == [("o0", 5), ("o1", 99), ("o2", 2)]


def test_latest_files_are_files_not_folders(spark, tmp_path):
    for n, (folder, name, v) in enumerate((("d1", "y", 1), ("d2", "y", 2), ("d1", "x", 3))):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.json").write_text(f'{{"v": {v}}}')
        os.utime(tmp_path / folder / f"{name}.json", (time.time() + 10 * n, time.time() + 10 * n))
    paths = rd.latest_file_per_name(spark, [str(tmp_path)], F.regexp_extract("path", r"([a-z]+)\.json$", 1), "*.json")
    assert sorted(x.v for x in spark.read.json(paths).collect()) == [2, 3]


def test_run_folder_is_removed(spark):
    session_conf = spark.conf.get("spark.checkpoint.dir")
    spark.range(1).write.parquet(fresh_path(spark, "x"))
    assert os.path.isdir(run_dir(spark)) and run_dir(spark).startswith(session_conf)
    remove_run(spark)
    assert not os.path.exists(run_dir(spark))


# -- plans --------------------------------------------------------------------


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_headers_and_lines_meet_in_an_inner_join(spark):
    heads = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, h string")
    items = spark.createDataFrame([(1, 10), (1, 11), (3, 12)], "k int, v int")
    both = j.heads_with_lines(heads, items, ["k"])
    got = {(x.k, x.h, x.v) for x in both.collect()}
    assert got == {(1, "a", 10), (1, "a", 11), (2, "b", None), (None, "c", None)}
    text = plan(both)
    assert "Inner" in text and "LeftOuter" not in text and "RightOuter" not in text


def test_event_windows_take_linear_time(spark):
    def run(days):
        daily = spark.range(days).selectExpr("'s' AS store", "date_add(DATE'1900-01-01', cast(id AS int)) AS d", "cast(id AS double) AS m")
        actions = daily.where("dayofmonth(d) = 1").selectExpr("store", "d AS action_date")
        start = time.time()
        j.event_window_join(actions, daily, "store", {"m": "sum"}, 3, "d").write.format("noop").mode("overwrite").save()
        return time.time() - start

    run(2000)
    assert run(32_000) < 8 * max(run(8000), 0.5)


def test_independence_keeps_its_cells_a_table(spark):
    df = spark.range(1000).selectExpr("id % 2 AS a", "cast(id % 3 = 0 AS int) AS b")
    assert "collect_list" not in plan(st.independence_test(df, "a", "b"))
