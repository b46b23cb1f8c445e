"""Versions of a keyed table that are compared by checksums of key buckets first.

The rows lie in buckets of their keys' hash, one partition each, and beside them the table keeps a checksum of every bucket's
keys and tracked columns. A new version is summed up the same way in one pass; only the buckets whose sums differ are read and
joined, and only these are written anew. The buckets are fixed when a table is made: as many as one wants to read apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillbook.functions.clean import text
from tillbook.operators.joins import snapshot_change_detect
from tillbook.session import stage
from tillbook.sources.versions import VersionedTable

BUCKETS = 256
BUCKET = "_bucket"


class Snapshot:
    """The latest version of a table at ``path`` with one row per ``keys``; ``tracked`` columns make a change."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], tracked: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.schema, self.keys, self.tracked, self.buckets = spark, schema, list(keys), list(tracked), buckets
        own = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        self.rows = VersionedTable(spark, f"{path}/rows", own, [BUCKET])
        self.sums = VersionedTable(spark, f"{path}/sums", StructType.fromDDL(f"{BUCKET} int, n long, low long, high decimal(38,0), slot int"), ["slot"])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.names]).withColumn(BUCKET, self._bucket())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[text(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def checksums(self, dealt: DataFrame) -> DataFrame:
        """(_bucket, n, low, high): order-free sums over each bucket's rows; a null differs from an empty text."""
        parts = [c for k in [*self.keys, *self.tracked] for c in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`").cast("string"))]
        sums = dealt.withColumn("_h", F.xxhash64(*parts)).withColumn("_g", F.xxhash64(F.lit(1), *parts))
        return sums.groupBy(BUCKET).agg(F.count("*").alias("n"), F.bit_xor("_h").alias("low"), F.sum(F.col("_g").cast("decimal(38,0)")).cast("decimal(38,0)").alias("high"))

    def differing(self, dealt: DataFrame) -> list[int]:
        """Buckets whose rows are not those of the latest version; at most ``buckets`` numbers."""
        new, old = self.checksums(dealt), self.sums.read().withColumnsRenamed({"n": "m", "low": "l", "high": "h"}).drop("slot")
        same = (F.col("n").eqNullSafe(F.col("m"))) & (F.col("low").eqNullSafe(F.col("l"))) & (F.col("high").eqNullSafe(F.col("h")))
        return sorted(r[0] for r in new.join(old, BUCKET, "full").where(~same).select(BUCKET).collect())

    def latest(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest rows, of some buckets only if they are named: the others' folders are not read."""
        rows = self.rows.read()
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)

    def changes(self, new: DataFrame) -> DataFrame:
        """New rows and rows that differ on a tracked column, with ``change_type``."""
        dealt = self._dealt(new)
        buckets = self.differing(dealt)
        asked = dealt.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        return snapshot_change_detect(asked, self.latest(buckets), self.keys, self.tracked)

    def update(self, new: DataFrame) -> list[int]:
        """``new`` becomes the latest version; returns the buckets that were written.

        Sums are published after the rows: stopped in between, the next update finds these buckets differing and writes them again.
        """
        dealt = stage(self._dealt(new))
        buckets = self.differing(dealt)
        if buckets:
            gone = self.spark.createDataFrame([(b,) for b in buckets], f"{BUCKET} int")
            self.rows.replace(dealt.where(F.col(BUCKET).isin(buckets)), emptied=gone)
            self.sums.replace(self.checksums(dealt).withColumn("slot", F.lit(0)), everything=True)
        return buckets
