"""Tables of partitions with a log: a write shows all at once, or not at all.

A table is a folder with ``data`` and ``log``. A write stages its rows under a name of its own, ``data/w=<name>/<partition>``,
which no reader looks at yet. It is published by one rename: its log entry, a small folder written before, becomes
``log/<version>``. An entry says for each partition it touches in which write the rows now are, or that there are none. The
state of a version is the last word on each partition up to it; a reader joins the files' partition values with that state,
which prunes the folders when the plan runs. So a reader sees the partitions of one version, never half a write; a write that
fails before its rename leaves staged files that no entry names; and of two writers of one version the second fails
(``Conflict``) and may try again on the new state.

An entry may carry a tag, such as the delivery it came from. Tag and rows are published together, so a job that asks
``applied`` first takes each delivery once, wherever it was stopped.

The rename must be atomic and must not replace a folder: so it is on HDFS and local disks, not on plain object stores.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillbook.session import fresh_path, stage
from tillbook.sources.writers import touched

DIGITS = 12
#: Marks of log rows: the entry replaces the whole table; it carries a tag; the partition keeps what it has beside this write.
EVERYTHING, TAG, APPEND = "everything", "tag", "append"
NULL = "\u0001null"


class Conflict(RuntimeError):
    """Another writer has published the version meanwhile."""


class VersionedTable:
    """A table at ``path``, partitioned by the columns ``by``; a blank partition value is the null partition."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str]):
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, list(by)
        if not set(self.by) <= set(schema.names) or not self.by:
            raise ValueError("the partition columns are columns of the table, one at least")
        # The log keeps partition values as text; the reader compares them with the folders' values as text.
        self._entry = StructType([*(StructField(f"p{i}", StringType()) for i in range(len(self.by))), StructField("w", StringType()), StructField("tag", StringType()), StructField("mark", StringType())])

    # -- the file system ----------------------------------------------------------

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        p, fs = self._hadoop(f"{self.path}/log")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def _publish(self, entry: DataFrame, version: int) -> None:
        made = f"{self.path}/log/.{uuid.uuid4().hex}"
        entry.coalesce(1).write.json(made)
        source, fs = self._hadoop(made)
        target, _ = self._hadoop(f"{self.path}/log/{version:0{DIGITS}d}")
        if fs.exists(target) or not fs.rename(source, target):
            fs.delete(source, True)
            raise Conflict(f"version {version} of {self.path} is published already")

    # -- reading --------------------------------------------------------------------

    def log(self) -> DataFrame:
        """(version, p0, ..., w, tag, mark) of all published entries."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], StructType([StructField("version", StringType()), *self._entry.fields])).withColumn("version", F.lit(0))
        entries = self.spark.read.schema(self._entry).json([f"{self.path}/log/{v:0{DIGITS}d}" for v in versions])
        return entries.withColumn("version", F.regexp_extract("_metadata.file_path", rf"/(\d{{{DIGITS}}})/[^/]+$", 1).cast("int")).select("version", *self._entry.names)

    def applied(self, tag: str) -> bool:
        """Whether an entry with this tag is published."""
        return not self.log().where(F.col("tag") == tag).isEmpty()

    def state(self, version: int | None = None) -> DataFrame:
        """(p0, ..., w): where the rows of each partition are in a version, the newest by default."""
        entries = self.log()
        if version is not None:
            entries = entries.where(F.col("version") <= version)
        first = entries.where(F.col("mark") == EVERYTHING).agg(F.max("version")).first()[0] or 0
        keys = [f"p{i}" for i in range(len(self.by))]
        entries = entries.where(F.col("version") >= first).where(F.coalesce(F.col("mark") == APPEND, F.lit(True)))
        # Since its last replacement a partition has that write and all that were appended to it.
        replaced = F.max(F.when(F.col("mark").isNull(), F.col("version"))).over(Window.partitionBy(*keys))
        valid = entries.withColumn("_replaced", F.coalesce(replaced, F.lit(0))).where(F.col("version") >= F.col("_replaced"))
        return valid.where(F.col("w").isNotNull()).select(*keys, "w").distinct()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default.

        The names of the writes that hold them come to the driver, as file lists do; partitions are pruned when the plan runs.
        """
        version = (self.versions() or [0])[-1] if version is None else version
        state = stage(self.state(version)) if version else None
        writes = [r[0] for r in state.select("w").distinct().collect()] if version else []
        if not writes:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*[f for f in self.schema.fields if f.name not in self.by], StructField("w", StringType()), *[self.schema[c] for c in self.by]])
        files = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/w={w}" for w in writes])
        known = state.where(F.col("w") != "")  # a predicate, so that the state prunes the folders
        same = files["w"] == known["w"]
        for i, c in enumerate(self.by):
            same = same & (F.coalesce(F.nullif(files[c].cast("string"), F.lit("")), F.lit(NULL)) == F.coalesce(known[f"p{i}"], F.lit(NULL)))
        return files.join(known, same, "left_semi").select(*[F.col(f"`{c}`") for c in self.schema.names])

    # -- writing --------------------------------------------------------------------

    def _texts(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(self.by)]).distinct()

    def replace(self, rows: DataFrame, emptied: DataFrame | None = None, tag: str | None = None, everything: bool = False, base: int | None = None) -> int:
        """Publish rows as the new content of the partitions they fall in; returns the version.

        ``emptied`` names further partitions (the columns ``by``) whose rows go if none of the new ones falls in them;
        ``everything`` replaces the whole table. ``base`` is the version that rows were made from.
        """
        base = (self.versions() or [0])[-1] if base is None else base
        write = self._stage_write(rows)
        filled = self._filled(write)
        entry = filled.withColumn("w", F.lit(write))
        if emptied is not None:
            keys = [f"p{i}" for i in range(len(self.by))]
            gone = self._texts(emptied).exceptAll(filled).withColumn("w", F.lit(None).cast("string"))
            entry = entry.unionByName(gone.select(*keys, "w"))
        return self._enter(entry, None, tag, everything, base)

    def append(self, rows: DataFrame, tag: str | None = None, base: int | None = None, staged: Callable[[str], None] = lambda write: None) -> int:
        """Publish rows beside those the table has; ``staged`` is called with the write's name before it is published."""
        base = (self.versions() or [0])[-1] if base is None else base
        write = self._stage_write(rows)
        staged(write)
        return self._enter(self._filled(write).withColumn("w", F.lit(write)), APPEND, tag, False, base)

    def _stage_write(self, rows: DataFrame) -> str:
        write = uuid.uuid4().hex
        rows = rows.select(*[F.col(f"`{c}`") for c in self.schema.names]).withColumn("w", F.lit(write))
        rows.hint("rebalance", *[F.col(c) for c in self.by]).write.mode("append").partitionBy("w", *self.by).parquet(f"{self.path}/data")
        return write

    def files_of(self, write: str) -> DataFrame:
        """The rows of one write, published or not."""
        schema = StructType([*[f for f in self.schema.fields if f.name not in self.by], *[self.schema[c] for c in self.by]])
        p, fs = self._hadoop(f"{self.path}/data/w={write}")
        if not fs.exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/w={write}")

    def _filled(self, write: str) -> DataFrame:
        return self._texts(self.files_of(write))

    def _enter(self, entry: DataFrame, mark: str | None, tag: str | None, everything: bool, base: int) -> int:
        entry = entry.withColumns({"tag": F.lit(tag).cast("string"), "mark": F.lit(mark).cast("string")})
        marks = [m for m, on in ((EVERYTHING, everything), (TAG, tag is not None)) if on]
        if marks:
            entry = entry.unionByName(self.spark.createDataFrame([(*[None] * len(self.by), None, tag, m) for m in marks], self._entry))
        self._publish(entry, base + 1)
        return base + 1

    def merge(self, new: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], tag: str | None = None) -> int:
        """``how(old, new)`` becomes the content of the partitions that the new rows fall in."""
        new, base = stage(new), (self.versions() or [0])[-1]
        old = touched(self.read(base), new, self.by)
        return self.replace(how(old, new), tag=tag, base=base)

    def rewrite(self, change: Callable[[DataFrame], DataFrame], tag: str | None = None) -> int:
        """``change(rows)`` becomes the whole table; partitions may move or vanish."""
        base = (self.versions() or [0])[-1]
        return self.replace(change(self.read(base)), tag=tag, everything=True, base=base)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the files that none of the last ``keep`` versions names; no write may be under way."""
        kept = set()
        for v in self.versions()[-keep:]:
            kept |= {r[0] for r in self.state(v).select("w").distinct().collect()}
        p, fs = self._hadoop(f"{self.path}/data")
        gone = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
        out = []
        for path in gone:
            if path.getName().startswith("w=") and path.getName()[2:] not in kept:
                fs.delete(path, True)
                out.append(path.getName()[2:])
        return out


def new_table(spark: SparkSession, schema: StructType, by: Sequence[str], name: str = "versions") -> VersionedTable:
    """An empty table in the run folder."""
    return VersionedTable(spark, fresh_path(spark, name), schema, by)
