"""Plan shapes that matter at scale."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillbook.operators.core import keep_one
from tillbook.operators import filters as fl
from tillbook.session import fresh_path
from tillbook.sources import readers as rd, writers as wr
from tillbook.sources.fixtures import Fixture

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_partition_filters_prune(spark):
    path = fresh_path(spark, "lake")
    wr.write_table(spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("store"), F.lit("2024-01").alias("ym")), path, ["store", "ym"])
    text = plan(rd.scan_partitioned(spark, path, store="1", ym=["2024-01"]))
    assert "PartitionFilters: [isnotnull(store" in text


def test_columns_and_filters_reach_the_scan(spark):
    t = Fixture(spark, SF)
    text = plan(t.heads.where(F.col("source") == "P").groupBy("store").agg(F.sum("order_amount")))
    assert "EqualTo(o_orderstatus,P)" in text and "o_orderdate" not in text and "c_acctbal" not in text


def test_keep_one_prunes_before_the_shuffle(spark):
    t = Fixture(spark, SF)
    text = plan(keep_one(t.table("lineitem"), ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") >= 2 and text.index("Partial") < text.index("Final")


def test_blacklist_has_no_nested_loop(spark):
    lines = spark.createDataFrame([("a", "s1")], "item string, store string")
    bl = spark.createDataFrame([("a", "s1,s2"), ("b", "")], "item_key string, stores string")
    text = plan(fl.store_scoped_blacklist(lines, bl, F.col("item")))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_cross_joins_or_python_in_headline_queries(spark):
    for name in ("store_risk_score", "collection_compare", "nearest_asof", "event_window_join", "cross_join_calendar", "missing_key_grid",
                 "range_join_launch", "unify_easy_pos", "review_topic_counts", "token_overlap_match", "independence_test", "group_compare"):
        text = plan(entry.queries()[name](spark, SF))
        for bad in ("NestedLoop", "Cartesian", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)
