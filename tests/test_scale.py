"""Plans and state that must stay small on the driver and in tasks however large the tables are."""

import glob
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tillbook.llm import simhash
from tillbook.operators import core
from tillbook.operators import order_lines as o
from tillbook.plans import master as ms, unify as u
from tillbook.session import fresh_path, reliable_checkpoint, stage, stage_all
from tillbook.streaming.ingest import changes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_variants_of_fingerprints_are_never_broadcast(spark):
    prints = stage(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    assert "BroadcastExchange" not in plan_of(simhash.links(prints))
    crowd = stage(spark.range(300).select(F.col("id").alias("fp")))
    found = simhash.links(crowd, hot=20)  # the variants' keys are crowded, so midpoints are joined too
    joins = plan_of(found)
    assert joins.count("SortMergeJoin") == 2
    small = {(r.a, r.b) for r in simhash.links(crowd, hot=1000).collect()}
    assert small == {(a, b) for a in range(300) for b in range(a + 1, 300) if (a ^ b).bit_count() <= 4}


def test_finalise_pending_reads_its_master_once(spark, monkeypatch):
    cols = "source string, code string, name string, label string, review_needed string, exclude_check string, approve string, updated_at date, version int, is_latest string"
    row = lambda code, name, label, open_: ("a", code, name, label, open_, "N", "", None, 1, "Y")
    rows = [row("1", "red ring", "RING", "N"), row("2", "red ring big", "", "Y"), row("3", "green box", "", "Y"), row("4", None, "", "Y")]
    master = spark.createDataFrame(rows, cols).withColumn("updated_at", F.to_date(F.lit("2001-01-01")))
    deep = master.where(F.col("version") + F.lit(4711) > 0)  # a mark of the master's own plan
    out = ms.finalise_pending(deep, "a", F.lit("RULE"), "2001-10-01", threshold=60)
    assert "4711" not in plan_of(out) and plan_of(out).count("\n") < 400
    got = {(r.code, r.version, r.label, r.is_latest) for r in out.collect()}
    assert got == {
        ("1", 1, "RING", "Y"), ("2", 1, "", "N"), ("2", 2, "RING", "Y"), ("3", 1, "", "N"), ("3", 2, "RULE", "Y"), ("4", 1, "", "N"), ("4", 2, "RULE", "Y"),
    }


def test_state_lies_in_buckets(spark):
    inbox, checkpoint, taken = fresh_path(spark, "in"), fresh_path(spark, "stream"), []
    schema = spark.createDataFrame([], "id string, part long, v string, sent long").schema

    def run():
        fresh = changes(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(inbox), ["id", "part"], "sent", None, buckets=4)
        query = fresh.writeStream.foreachBatch(lambda b, _: taken.append({tuple(r) for r in b.collect()})).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:])

    def drop(name, *rows):
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{inbox}/{name}")

    first = [(str(i), i % 3, None, 1) for i in range(500)] + [(None, None, "n", 1), ("0", 9, "other part", 1), ("7", 1, "stale", 0)]
    drop("a", *first)
    assert run() <= 4  # keys of one state before
    assert taken[0] == set(first[:-1])
    drop("b", ("0", 0, None, 1), ("1", 1, "new", 2), (None, None, "n", 1), (None, None, "m", 2), ("2", 2, "old", 0))
    run()
    assert set().union(*taken[1:]) == {("1", 1, "new", 2), (None, None, "m", 2)}


def test_canonical_key_is_the_values(spark):
    rows = [(1, "a ", 1.0, 1), (1, "a", 1.0000001, 2), (1, "a", 1.00001, 1), (None, None, None, 1), (None, "", None, 2)]
    lines = spark.createDataFrame(rows, "id long, t string, x double, run int")
    out = o.canonical_line_dedup(lines, {"id": True, "t": False, "x": True}, [F.col("run").desc()])
    assert "sha2" not in plan_of(out)
    assert {tuple(r) for r in out.collect()} == {rows[1], rows[2], rows[4]}


def test_platform_b_shuffles_its_lines_once(spark):
    plan = plan_of(lines_of_b(spark, None))
    assert plan.count("hashpartitioning(_order") + plan.count("hashpartitioning(order_id") == 1
    strip = lambda df: sorted(map(str, df.drop("_order").collect()))
    hot = spark.createDataFrame([("o1",)], "order_id string")
    assert strip(lines_of_b(spark, None)) == strip(lines_of_b(spark, hot)) != []


def lines_of_b(spark, hot):
    cols = "order_id string, ordered_at string, store string, brand string, delivery_type string, menu_name string, menu_options string, menu_qty long, menu_price long, total long, sales long, cancelled string, collected_at int, n long"
    line = lambda order, n, option, price, at: (order, "2024.3.1 10:05", "S1", "B", "", "M", option, 1, price, 900, None, "N", at, n)
    raw = [line("o1", 1, "x", 500, 1), line("o1", 2, "y", None, 1), line("o1", 2, "y", None, 2), line("o2", 1, "x", 700, 1), line("o2", 1, "x", 700, 2), line(None, 1, "z", 300, 1)]
    stores = spark.createDataFrame([("S1", "r", "m", None)], "store string, region string, manager string, open_date date")
    prices = spark.createDataFrame([("y", 100)], "item_name string, option_price long")
    dedup = {"order_id": False, "n": True, "menu_qty": True}
    return u.unify_platform_b(spark.createDataFrame(raw, cols), stores, prices, ["n"], dedup, hot=hot)


def receipt(n, store="BRAND S1", pos="01", amount=100, **kw):
    given = {"sale_date": "2024-03-01", "store": store, "pos_no": pos, "receipt_no": n, "kind": "매출", "channel": "POS", "order_kind": "매장", "table_name": "7", "actual_amount": amount, "order_time": "12:30"}
    return given | kw


def test_receipts_go_through_few_windows(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(u, "stage", lambda df: staged.append(plan_of(df)) or stage(df))
    heads = [receipt("1"), receipt("2", amount=90), receipt("3", kind="반품", amount=-100), receipt("1", sale_date="2024-03-02", kind="반품", amount=-7), receipt("9", amount=5)]
    head = "sale_date string, store string, pos_no string, receipt_no string, kind string, channel string, order_kind string, table_name string, actual_amount long, order_time string"
    line = lambda n, i, code, name, amount: ("2024-03-01", "BRAND S1", "1", n, code, name, 1, amount, 0, i)
    items = [line("1", 1, "a", "soup", 60), line("1", 2, "b", "rice", 40), line("2", 1, "b", None, 80), line("9", 1, None, "", 5)]
    item = "sale_date string, store string, pos_no string, receipt_no string, item_id string, item_name string, qty long, amount long, discount_amount long, n long"
    stores = spark.createDataFrame([("S1", "r", "m", None)], "store string, region string, manager string, open_date date")
    master = spark.createDataFrame([("a", "SOUP", "Y", None), ("a", "Soup", "N", "N"), ("b", None, "N", "N"), ("", "blank", "N", "N")], "code string, name string, is_main_candidate string, exclude_check string")
    day = lambda df: df.withColumn("sale_date", F.to_date("sale_date"))
    args = day(spark.createDataFrame([tuple(h[c.split()[0]] for c in head.split(", ")) for h in heads], head)), day(spark.createDataFrame(items, item)), stores, master
    hot = spark.createDataFrame([("1", "1", "BRAND S1", "2024-03-01")], "receipt_no string, pos_no string, store string, sale_date string")
    pick = lambda h: sorted(tuple(r) for r in u.unify_receipts(*args, ["n"], ["POS"], "PHONE", hot=h).select("order_id", "item_seq", "item_name", "menu_name", "total_price", "order_cnt").collect())
    want = sorted([
        ("S1_1-1_12:30:00", 1, "SOUP", "soup", 60, 0), ("S1_1-1_12:30:00", 2, "rice", "soup", 40, 1), ("S1_1-2_12:30:00", 1, "", "", 80, 1),
        ("S1_1-2_12:30:00", 2, "정산차액", "", 10, 0), ("S1_1-3_12:30:00", 1, "blank", "soup", -100, -1), ("S1_1-1_12:30:00", 1, "blank", "soup", -7, -1),
        ("S1_1-9_12:30:00", 1, "blank", "", 5, 1),
    ])
    assert pick(None) == want
    assert sum(line.lstrip(" +-:*()0123456789").startswith("Window ") for line in staged[0].split("\n")) <= 3  # six before
    assert pick(day(hot)) == want


def test_local_stamps_are_matched_once_for_each_value(spark):
    from tillbook.functions.clean import LOCAL_STAMP, parse_localized_datetime

    stamps = ["2026. 06. 15. (월) 오후 10:48:04", "2026.1.2 3:04", "2026. 1. 2 오전 12:00", "\t2026.02.30 1:02:03|x", "2026.1.2 오후13:04 later\n2027.1.1 1:00", "no", "", None]
    df = stage(spark.createDataFrame([(i, x) for i, x in enumerate(stamps)], "i int, t string"))
    day, clock = parse_localized_datetime("t")
    out = df.select("i", day.cast("string").alias("day"), clock.alias("clock"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("오전|오후") <= 4  # one for each part and use before
    assert [tuple(r)[1:] for r in out.orderBy("i").collect()] == [
        ("2026-06-15", "22:48:04"), ("2026-01-02", "03:04:00"), ("2026-01-02", "00:00:00"), (None, "01:02:03"), ("2026-01-02", "25:04:00"),
        (None, None), (None, None), (None, None),
    ]


def test_recalculation_takes_the_hot_orders_of_the_feed(spark, monkeypatch):
    import __spark_entry__ as entry
    from tillbook.operators import core

    counted = []
    original = core.reliable_checkpoint
    monkeypatch.setattr(core, "reliable_checkpoint", lambda df: counted.append(df) or original(df))
    entry.queries()["recalculate_order_fields"](spark, "/root/testdata/sf0.001")
    assert len(counted) == 1  # by code, by id and on the finished feed before


def test_union_pos_goes_through_few_windows(spark):
    import __spark_entry__ as entry

    plan = plan_of(entry.queries()["unify_union_pos"](spark, "/root/testdata/sf0.001"))
    order_windows = [x for x in plan.split("\n") if x.lstrip(" +-:*()0123456789").startswith("Window ") and "order_id" in x]
    assert 0 < len(order_windows) <= 3  # six before
    assert "LeftAnti" not in plan


@pytest.fixture
def sliced(spark, monkeypatch):
    """Sets the rows of a slice; the plans of the slices written."""
    plans = []
    monkeypatch.setattr(u, "stage_all", lambda parts: stage_all(plans.append(plan_of(df)) or df for df in parts))
    yield lambda rows: spark.conf.set(core.SLICE_CONF, str(rows)) or plans
    spark.conf.unset(core.SLICE_CONF)


@pytest.mark.parametrize("name", ["unify_receipts", "unify_platform_b", "unify_union_pos"])
def test_source_jobs_go_through_their_lines_in_slices(spark, sliced, name):
    """The shuffles of all 6000 lines lay on disk at a time before; the oracle does not know about slices."""
    import __spark_entry__ as entry
    from oracle_check import compare, oracle

    plans, sf = sliced(7000), "/root/testdata/sf0.001"
    ok, note = compare(spark, oracle(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert ok, note
    assert len(plans) == 3
    for plan in plans:  # a slice shuffles no lines of others: those are left out where their table is read
        assert any("Filter" in x and "xxhash64" in x and "l_orderkey" in x for x in plan.split("\n"))


def test_order_ids_that_look_alike_share_a_slice(spark, sliced):
    """POS 1_2 with receipt 3_n and POS 1 with receipt 2_3_n have one order id; so have 007 and 7 on one POS."""
    cols = "sale_date date, store string, receipt_no string, pos_no string, sold_at string, sale_type string"
    day = lambda df: df.withColumn("sale_date", F.to_date(F.lit("2024-03-01"))).select(*[x.split()[0] for x in cols.split(", ")])
    pos = [(None, f"S{k}", receipt, pos, at, "판매") for n in range(12) for at in ("2024-03-01 1:00", None, f"x_{n}") for k, (pos, receipt) in enumerate([("1_2", f"3_{n}"), ("1", f"2_3_{n}"), ("4", f"00{n}"), ("4", str(n))])]
    plain = [x for x in pos if "_" not in x[3]]
    items = [(h[1], h[2], h[4], str(i), f"dish {h[1]}{i}", "판매", f"{i * 100 + int(h[1][1])}", 1, "", i) for h in pos for i in (1, 2)]
    stores = spark.createDataFrame([(f"S{k}", "r", "m", None) for k in range(4)], "store string, region string, manager string, open_date date")
    master = spark.createDataFrame([("1", "dish", "Y", "N")], "code string, name string, is_main_candidate string, exclude_check string")
    item = "store string, receipt_no string, sold_at string, item_id string, item_name string, item_sale_type string, amount string, qty long, category string, n long"
    for heads in (pos, plain):
        frames = day(spark.createDataFrame(heads, cols.replace("sale_date date", "sale_date string"))), spark.createDataFrame(items, item)
        run = lambda rows: sliced(rows) is None or sorted(map(str, u.unify_union_pos(*frames, stores, master, ["store", "n"]).collect()))
        whole = run(10**6)
        assert run(150) == whole != [] and len(sliced(150)) > 2
        sliced(150).clear()


def test_hot_keys_and_rows_are_counted_in_one_pass(spark):
    sizes = spark.createDataFrame([("a", None, 7), (None, None, 9), ("b", 1, 2)], "x string, y int, _n long")
    spark.conf.set(core.HOT_CONF, "5")
    try:
        hot, rows = core.hot_and_rows(sizes)
        assert {tuple(r) for r in hot.collect()} == {("a", None), (None, None)} and rows == 18
        assert core.hot_and_rows(sizes.where("_n < 5")) == (None, 2) and core.hot_and_rows(sizes.where("false")) == (None, 0)
    finally:
        spark.conf.unset(core.HOT_CONF)
    assert [core.slice_count(spark, *x) for x in ((0, 3), (1, 3), (core.SLICE_ROWS, 1), (core.SLICE_ROWS, 2), (core.SLICE_ROWS + 1, 1))] == [1, 1, 1, 2, 2]


def test_checkpoints_leave_no_shuffle_files(spark):
    files = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))
    before = files()
    kept = reliable_checkpoint(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and len(kept.collect()) == 7
