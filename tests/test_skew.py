"""Hot groups take another plan; the results must not change."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillbook.operators import order_lines as o
from tillbook.operators.core import attach, global_rank, hot_keys, running, running_total


@pytest.fixture(scope="module")
def rows(spark):
    # One order holds a third of all lines, one order key is null.
    n = 900
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("o"), F.col("id") % 40)).alias("order_id"),
        F.col("id").alias("pos"), (F.col("id") * 37 % 101).alias("v"),
        F.when(F.col("id") % 7 == 2, F.concat(F.lit("m"), F.col("id"))).alias("mark"),
    )
    return base


def as_set(df):
    return sorted(map(str, df.collect()))


SPECS = {"n": ("count", None), "s": ("sum", "v"), "l": ("last", "mark")}


def test_running_hot_equals_window(rows):
    plain = running(rows, ["order_id"], ["pos"], SPECS, hot=None)
    hot = running(rows, ["order_id"], ["pos"], SPECS, hot=hot_keys(rows, ["order_id"], 50))
    assert as_set(plain) == as_set(hot)


def test_running_whole_table(rows):
    plain = running(rows.withColumn("one", F.lit(1)), ["one"], ["pos"], SPECS, hot=None).drop("one")
    assert as_set(plain) == as_set(running_total(rows, ["pos"], SPECS))


def test_attach_hot_equals_window(rows):
    aggs = {"t": F.sum("v"), "b": F.max(F.struct("v", "pos"))}
    hot = hot_keys(rows, ["order_id"], 50)
    assert {r.order_id for r in hot.collect()} == {"hot"}
    assert as_set(attach(rows, ["order_id"], aggs, hot=None)) == as_set(attach(rows, ["order_id"], aggs, hot=hot))


def test_no_hot_keys(rows):
    assert hot_keys(rows, ["order_id"], 10_000) is None


def test_order_line_operators_on_hot_order(rows):
    df = o.item_seq(rows.where(F.col("order_id").isNotNull()), ["order_id"], ["pos"], hot=None).withColumns(
        {"price": F.when(F.col("v") % 3 > 0, F.col("v")), "opt": F.col("v") % 4, "qty": F.lit(1), "amount": F.lit(1000)}
    )
    hot = hot_keys(df, ["order_id"], 50)
    a = {}
    for name, h in (("cold", None), ("hot", hot)):
        g = o.menu_group_segments(df, ["order_id"], "price", hot=h)
        r = o.remainder_allocation(g, ["order_id"], "menu_group", "price", "qty", "opt", "amount", "part", hot=h)
        a[name] = as_set(r.select("order_id", "item_seq", "menu_group", "part"))
        sums = {x.s for x in r.groupBy("order_id").agg(F.sum("part").alias("s")).collect()}
        assert sums == {1000}
    assert a["cold"] == a["hot"]


def test_global_rank_hot_equals_window(rows):
    plain = rows.withColumn("r", F.when(F.col("v").isNotNull(), F.rank().over(Window.orderBy(F.col("v").desc_nulls_last()))).cast("bigint"))
    assert as_set(global_rank(rows, "v", "r")) == as_set(plain)


@pytest.mark.parametrize("name", ["unify_receipts", "unify_delivery_feed", "unify_union_pos", "unify_platform_b", "platform_orders_extract"])
def test_source_jobs_with_hot_orders_match_oracle(spark, monkeypatch, name):
    """Orders of more than six lines take the hot path, from the join of headers and lines on; the oracle does not know about it."""
    import __spark_entry__ as entry
    from oracle_check import compare, oracle
    from tillbook.operators import core

    seen = []
    original = core.reliable_checkpoint
    monkeypatch.setattr(core, "reliable_checkpoint", lambda df: seen.append(df) or original(df))
    spark.conf.set(core.HOT_CONF, "6")
    sf = "/root/testdata/sf0.001"
    try:
        ok, note = compare(spark, oracle(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    finally:
        spark.conf.unset(core.HOT_CONF)
    assert ok, note
    assert len(seen) > 1  # the hot keys and rows of hot groups
