"""Adapters: the star-schema test tables seen as the sales domain's inputs."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CANCELLED = "취소"
NORMAL = "정상"
# Every job takes the report day as a parameter; the test tables end here.
AS_OF = "2001-08-01"

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


class Fixture:
    """Lazy views over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def stores(self) -> DataFrame:
        """Store dimension: key, name, region, manager, opening date."""
        n, r = self.table("nation"), self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("store_key"),
            F.col("n_name").alias("store"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("MGR_"), F.col("n_nationkey") % 7).alias("manager"),
            F.date_add(F.lit("1995-01-01").cast("date"), F.col("n_nationkey") * 30).alias("open_date"),
        )

    @cached_property
    def heads(self) -> DataFrame:
        """Order headers with store, platform and amount."""
        o, c = self.table("orders"), self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return (
            o.join(c, o.o_custkey == c.c_custkey)
            .join(self.stores, F.col("c_nationkey") == F.col("store_key"))
            .select(
                "o_orderkey",
                F.col("o_orderdate").cast("date").alias("sale_date"),
                F.date_format("o_orderdate", "yyyy-MM").alias("ym"),
                F.col("o_orderstatus").alias("source"),
                "store", "region", "manager", "open_date",
                F.col("c_mktsegment").alias("platform"),
                F.col("o_orderpriority").alias("order_type"),
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.concat(
                    F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"), F.lit(":00"),
                ).alias("order_time"),
                F.round("o_totalprice").cast("bigint").alias("order_amount"),
            )
        )

    @cached_property
    def raw_lines(self) -> DataFrame:
        """Order items with whole-number money, unsigned."""
        price, disc = F.col("l_extendedprice"), F.col("l_discount")
        return self.table("lineitem").withColumns(
            {
                "qty": F.col("l_quantity").cast("bigint"),
                "list_amount": F.round("l_extendedprice").cast("bigint"),
                "net_amount": F.round(price * (1 - disc)).cast("bigint"),
                "discount_amount": F.round(price * disc).cast("bigint"),
                "settle_amount": F.round(price * (1 - disc) * (1 - F.col("l_tax"))).cast("bigint"),
                "unit_price": F.round(price / F.col("l_quantity")).cast("bigint"),
            }
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Unified sales lines: one row per order item, cancelled ones negative."""
        l, h = self.raw_lines, self.heads
        sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
        return (
            l.join(h, l.l_orderkey == h.o_orderkey)
            .withColumns(
                {
                    "brand": F.col("l_linestatus"),
                    "item_id": F.col("l_partkey").cast("string"),
                    "sale_type": F.when(F.col("l_returnflag") == "R", CANCELLED).otherwise(NORMAL),
                    "total_price": sign * F.col("net_amount"),
                    "order_cnt": F.when(F.col("l_linenumber") == 1, sign).otherwise(0).cast("bigint"),
                }
            )
        )

    @cached_property
    def series(self) -> DataFrame:
        """Daily store series: sales, settlement, orders."""
        return self.lines.groupBy("sale_date", "store", "manager").agg(
            F.sum("total_price").alias("total_amount"),
            F.sum(F.when(F.col("l_returnflag") == "R", -F.col("settle_amount")).otherwise(F.col("settle_amount"))).alias(
                "settlement_amount"
            ),
            F.countDistinct("order_id").alias("total_order_count"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Event log as change / click / run log per store."""
        return self.table("events").select(
            "event_id", "ts", F.col("ts").cast("date").alias("d"), "user_id",
            F.concat(F.lit("S"), F.lpad((F.col("user_id") % 25).cast("string"), 2, "0")).alias("store"),
            "event_type", F.round(F.col("value") * 100).cast("bigint").alias("amount"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"), "props",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Documents with their labels as reviews of a store."""
        d, l = self.table("documents"), self.table("labels")
        return d.join(l, "doc_id", "left").select(
            "doc_id",
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("d"),
            F.concat(F.lit("S"), F.lpad((F.col("doc_id") % 25).cast("string"), 2, "0")).alias("store"),
            F.concat(F.lit("MGR_"), (F.col("doc_id") % 25) % 7).alias("manager"),
            F.col("source").alias("channel"), F.col("lang").alias("topic"),
            F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("sentiment"),
            "quality", "toxic", "text", "n_chars",
        )

    @cached_property
    def products(self) -> DataFrame:
        """Product master."""
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("code"), F.col("p_partkey").alias("part_key"),
            F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("label"),
            F.col("p_size").alias("size"), F.round("p_retailprice").cast("bigint").alias("list_price"),
        )
