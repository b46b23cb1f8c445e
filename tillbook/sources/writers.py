"""Write semantics on parquet folders: merges as plain frames, and safe rewrites.

A plan never reads and overwrites the same folder: the result is staged on the
shared folder first, then the touched partitions are replaced dynamically.
Operations that can empty partitions write a new version of the table instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.functions.clean import text
from tillbook.operators.core import keep_one
from tillbook.session import fresh_path, stage


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Partitioned write; rebalancing keeps files large and splits hot partitions over several tasks."""
    out = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    writer = out.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Stage the rows, then replace exactly the partitions they fall in."""
    write_table(stage(df), path, by)


def touched(existing: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Existing rows of the partitions that the new rows fall in.

    A blank text lies in the same folder as a null. Rows whose keys are all known meet in an equi join, which prunes
    folders when the plan runs; the others are matched with nulls as equals, among the null folders only.
    """
    if not by:
        return existing
    stored = [F.nullif(F.col(c), F.lit("")).alias(c) if dict(new.dtypes)[c] == "string" else F.col(c) for c in by]
    wanted = new.select(*stored).distinct()
    known = F.lit(True)
    for c in by:
        known = known & F.col(c).isNotNull()
    theirs = wanted.where(~known).withColumnsRenamed({c: f"_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    plain = existing.join(wanted.where(known), list(by), "left_semi")
    return plain.unionByName(existing.where(~known).join(theirs, same, "left_semi"))


# -- merges -------------------------------------------------------------------


def unique_new(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def append_unique(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Append rows with unseen keys; returns one row (inserted, duplicated, total)."""
    existing = read_table(spark, path, new)
    done = stage(new.join(existing.select(*keys).distinct().withColumn("_seen", F.lit(1)), list(keys), "left"))
    write_table(done.where(F.col("_seen").isNull()).select(*new.columns), path, by, mode="append")
    return done.agg(
        F.count_if(F.col("_seen").isNull()).alias("inserted"), F.count("_seen").alias("duplicated"), F.count(F.lit(1)).alias("total")
    )


def keep_last(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Union in which the new row of a key wins, and among several new rows the first by ``order``."""
    both = existing.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, [F.col("_v").desc(), *order]).drop("_v")


def replace_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows without the key tuples of new (nulls are equal), plus all new rows."""
    theirs = new.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return existing.join(theirs, same, "left_anti").unionByName(new, allowMissingColumns=True)


def row_signature(columns: Sequence[str]) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[text(c) for c in columns]), 256)


def merge_by_signature(existing: DataFrame, new: DataFrame, columns: Sequence[str], order: Sequence) -> DataFrame:
    """Union of two logs, one row per signature over the business columns."""
    both = existing.unionByName(new, allowMissingColumns=True).withColumn("_sig", row_signature(columns))
    return keep_one(both, ["_sig"], order).drop("_sig")


def source_aware_replace(
    existing: DataFrame, new: DataFrame, source: str, pk: str, order: Sequence, stores: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one source (optionally of given stores) replaced by new ones, all others kept, unique by key."""
    mine = F.lower(F.trim("source")) == source.lower()
    if stores is not None:
        mine = mine & F.col("store").isin(list(stores))
    kept = existing.where(~F.coalesce(mine, F.lit(False)))
    return keep_last(kept, new, [pk], order)


def same_keys(existing: DataFrame, new: DataFrame, pk: str) -> bool:
    """True when both sides hold the same key set, so a rewrite would change nothing."""
    a, b = existing.select(pk), new.select(pk)
    return a.join(b, pk, "left_anti").isEmpty() and b.join(a, pk, "left_anti").isEmpty()


def source_priority_override(existing: DataFrame, better: DataFrame, keys=("sale_date", "store", "platform")) -> DataFrame:
    """The better source replaces whole key groups; where it has nothing the old rows stay."""
    return replace_by_key(existing, better, keys)


# -- table operations ---------------------------------------------------------


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], by: Sequence[str], order: Sequence) -> None:
    """Merge new rows into the partitions they touch; per key the new row stays, of several the first by ``order``.

    The partition of a row must follow from its key: a key that moved leaves its old row behind.
    """
    new = stage(new)
    old = touched(read_table(spark, path, new), new, by)
    replace_partitions(keep_last(old, new, keys, order), path, by)


def replace_units(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], by: Sequence[str], version: Column) -> None:
    """Replace whole units, such as all lines of an order, by their newest version in the new rows.

    ``keys`` name a unit, ``version`` orders its arrivals; equal rows of one version count once. As in ``upsert`` the
    partition must follow from the keys.
    """
    ranked = new.distinct().withColumn("_v", F.rank().over(Window.partitionBy(*keys).orderBy(version.desc_nulls_last())))
    latest = stage(ranked.where(F.col("_v") == 1).drop("_v"))
    old = touched(read_table(spark, path, latest), latest, by)
    replace_partitions(replace_by_key(old, latest, keys), path, by)


def partitioned_write(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], by: Sequence[str], stamp: str, tie: Sequence = ()
) -> None:
    """Merge into partitions; per key the row collected last wins, whichever side it is on."""
    new = stage(new)
    old = touched(read_table(spark, path, new), new, by)
    merged = keep_one(old.unionByName(new), [*by, *keys], [F.col(stamp).desc_nulls_last(), *tie])
    replace_partitions(merged, path, by)


def repartition_by_business_date(df: DataFrame, out: str, pk: str, day: str, by: Sequence[str], order: Sequence) -> None:
    """New version of the table: unique by key and bucketed by its own business date."""
    write_table(keep_one(df, [pk], order).withColumn("ym", F.date_format(day, "yyyy-MM")), out, by)


def purge_source(df: DataFrame, out: str, source: str, by: Sequence[str]) -> None:
    """New version of the table without one source."""
    write_table(df.where(F.coalesce(F.lower(F.trim("source")) != source.lower(), F.lit(True))), out, by)


def partition_key_migration(df: DataFrame, aliases: DataFrame, out: str, pk: str, by: Sequence[str], order: Sequence, column="store") -> None:
    """New version with renamed partition keys, merged into the new key without duplicates."""
    a = aliases.select(F.col("old").alias(column), F.col("new").alias("_new"))
    moved = df.join(a, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")
    write_table(keep_one(moved, [column, pk], order), out, by)


def legacy_partitions(df: DataFrame, aliases: DataFrame, column="store") -> DataFrame:
    """Partition keys still under an old name, with their row counts (dry run)."""
    a = aliases.select(F.col("old").alias(column), "new")
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).join(a, column)


def fix_partition_ym(details: DataFrame, orders: DataFrame, out: str, code: str, day: str, key: Sequence[str], order: Sequence, by=("ym",)) -> None:
    """New version in which each detail row lies in the month of its order's date."""
    look = keep_one(orders, [code], [day]).select(code, F.date_format(day, "yyyy-MM").alias("_ym"))
    moved = details.join(look, code, "left").withColumn("ym", F.coalesce("_ym", "ym")).drop("_ym")
    write_table(keep_one(moved, [*by, *key], order), out, list(by))


def prune_pre_open(df: DataFrame, stores: DataFrame, out: str, by: Sequence[str]) -> None:
    """New version without rows dated before the store's opening; unknown dates stay."""
    d = stores.select("store", F.col("open_date").alias("_open"))
    keep = F.col("sale_date").isNull() | F.col("_open").isNull() | (F.col("sale_date") >= F.col("_open"))
    write_table(df.join(d, "store", "left").where(keep).drop("_open"), out, by)
