"""Scans: parquet unions, partitioned lakes, newest files, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.core import keep_one


def scan_parquet_union(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, source_col: str | None = None
) -> DataFrame:
    """Files of differing schemas as one table; wanted columns no file has come out null."""
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    out = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns or df.columns]
    if source_col:
        out.append(F.col("_metadata.file_path").alias(source_col))
    return df.select(*out)


def scan_partitioned(spark: SparkSession, root: str, **keys) -> DataFrame:
    """Hive-partitioned lake with optional key filters (values or lists), which prune folders."""
    df = spark.read.option("basePath", root).parquet(root)
    for k, v in keys.items():
        if v is not None:
            df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
    return df


def latest_file_per_name(spark: SparkSession, paths: Sequence[str], name: Column, glob: str = "*.parquet") -> list[str]:
    """Of the files that share a logical name (an expression on ``path``) those of the newest write, that is of the folder with the newest one.

    The listing reads no content; only paths come to the driver. Older files that lie in the same folder under another
    name are not among them.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(list(paths))
        .select("path", "modificationTime").withColumn("_name", name)
        .withColumn("_folder", F.regexp_replace("path", r"/[^/]+$", ""))
    )
    folders = files.groupBy("_name", "_folder").agg(F.max("modificationTime").alias("_t"))
    newest = keep_one(folders, ["_name"], [F.col("_t").desc(), F.col("_folder").desc()]).select("_name", "_folder")
    return [r[0] for r in files.join(newest, ["_name", "_folder"], "left_semi").select("path").orderBy("path").collect()]


def table_read(
    table: DataFrame, columns: Sequence[str] | None = None, where: dict | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """SELECT columns WHERE equalities ORDER BY (a leading '-' sorts descending).

    ``table`` is any relation; for a JDBC relation Spark pushes columns and filters down.
    """
    for k, v in (where or {}).items():
        table = table.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple)) else F.col(k).eqNullSafe(F.lit(v)))
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order_by]
    table = table.select(*(columns or table.columns))
    return table.orderBy(*order) if order else table


def jdbc_table(spark: SparkSession, url: str, name: str, partition_column: str, bounds: tuple, partitions: int, **options) -> DataFrame:
    """Parallel JDBC relation, split on a numeric or date column."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=partition_column, lowerBound=str(bounds[0]),
                                          upperBound=str(bounds[1]), numPartitions=str(partitions), **options).load()
    )
