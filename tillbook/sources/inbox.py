"""Deliveries into an inbox: each run has a manifest of its own, and is merged exactly once into the tables of its datasets.

A manifest is a JSON file ``manifest_*.json`` in the inbox: ``{"run": name, "files": {file: {"rel": "dataset/...", "size": bytes}}}``.
A run is ready when all its files lie there with the sizes named and nothing of it is younger than ``min_age_minutes``. A job
claims a ready run by creating a file, which only one job can; a claim older than ``lease_minutes`` belongs to a job that died
and may be taken over. Each dataset of the run goes into its table by its own policy, published together with the run's name
as tag (``sources.versions``). So a job that stopped between two datasets, or after its last one, is simply run again: tables
that have the tag are left as they are. A run whose datasets are all in is marked done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.sources.versions import VersionedTable
from tillbook.sources.writers import keep_last, merge_by_signature, replace_by_key

MANIFEST = "run string, files map<string, struct<rel: string, size: bigint>>"
Policy = Callable[[DataFrame, DataFrame], DataFrame]


def keyed(keys: Sequence[str], order: Sequence) -> Policy:
    """A row per key; the delivered row wins, of several the first by ``order``."""
    return lambda old, new: keep_last(old, new, keys, order)


def units(keys: Sequence[str]) -> Policy:
    """Whole units, such as all lines of an order, are replaced by the delivered ones."""
    return lambda old, new: replace_by_key(old, new, keys)


def by_signature(columns: Sequence[str], order: Sequence) -> Policy:
    """A log: one row per signature over the columns."""
    return lambda old, new: merge_by_signature(old, new, columns, order)


def whole() -> Policy:
    """The delivered rows replace the partitions they fall in."""
    return lambda old, new: new


@dataclass
class Dataset:
    table: VersionedTable
    policy: Policy
    #: Reads the dataset's files of a run.
    read: Callable[[SparkSession, list[str]], DataFrame] = lambda spark, paths: spark.read.parquet(*paths)


def manifests(spark: SparkSession, inbox: str) -> DataFrame:
    """(manifest, run, file, rel, size, written): the files each readable manifest names."""
    found = spark.read.option("wholetext", True).option("pathGlobFilter", "manifest_*.json").text(inbox)
    found = found.select(F.col("_metadata.file_path").alias("manifest"), F.col("_metadata.file_modification_time").alias("written"), F.from_json("value", MANIFEST).alias("m"))
    own = F.regexp_extract("manifest", r"manifest_([^/]*)\.json$", 1)
    return found.where("m.files IS NOT NULL").select("manifest", F.coalesce("m.run", own).alias("run"), "written", F.explode("m.files").alias("file", "info")).select("manifest", "run", "written", "file", "info.rel", "info.size")


def ready_runs(spark: SparkSession, inbox: str, now: datetime, min_age_minutes: int = 10) -> DataFrame:
    """(run, dataset, file): the files of the runs that have arrived in full, as the inbox holds them."""
    named = manifests(spark, inbox)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inbox).select("path", "length", "modificationTime")
    root = inbox.rstrip("/").split(":", 1)[-1].lstrip("/")
    there = there.select(F.element_at(F.split("path", root + "/", 2), 2).alias("_file"), F.col("length"), "modificationTime")
    old = lambda c: F.col(c) <= F.lit(now) - F.expr(f"INTERVAL {int(min_age_minutes)} MINUTES")
    here = named.join(there, F.col("file") == F.col("_file"), "left")
    good = F.coalesce((F.col("length") == F.col("size")) & old("modificationTime") & old("written") & F.col("rel").isNotNull(), F.lit(False))
    runs = here.groupBy("run").agg(F.every(good).alias("good")).where("good").select("run")
    return named.join(runs, "run", "left_semi").select("run", F.split("rel", "/")[0].alias("dataset"), "file")


class Ledger:
    """Claims and finished runs, as files that only one job can create."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, kind: str, run: str) -> str:
        return f"{self.path}/{kind}/" + "".join(c if c.isalnum() or c in "._=-" else f"%{ord(c):x}" for c in run)

    def claim(self, run: str, lease_minutes: int = 60) -> bool:
        p, fs = self._hadoop(self._file("claims", run))
        if fs.exists(p):
            written = fs.getFileStatus(p).getModificationTime()
            now = self.spark.sparkContext._jvm.System.currentTimeMillis()
            if now - written < lease_minutes * 60_000 or not fs.delete(p, False):
                return False
        return fs.createNewFile(p)

    def release(self, run: str) -> None:
        p, fs = self._hadoop(self._file("claims", run))
        fs.delete(p, False)

    def finish(self, run: str) -> None:
        p, fs = self._hadoop(self._file("done", run))
        fs.createNewFile(p)
        self.release(run)

    def finished(self, run: str) -> bool:
        p, fs = self._hadoop(self._file("done", run))
        return fs.exists(p)


def merge_inbox(
    spark: SparkSession, inbox: str, datasets: dict[str, Dataset], ledger: str, now: datetime, min_age_minutes: int = 10, lease_minutes: int = 60
) -> list[tuple[str, str, str]]:
    """Merge all ready runs, oldest name first; (run, dataset, what was done: merged, was merged, unknown dataset, claimed)."""
    book, out = Ledger(spark, ledger), []
    runs: dict[str, dict[str, list[str]]] = {}
    for r in ready_runs(spark, inbox, now, min_age_minutes).collect():  # file names, as any scan lists them
        runs.setdefault(r.run, {}).setdefault(r.dataset, []).append(f"{inbox.rstrip('/')}/{r.file}")
    for run in sorted(runs):
        if book.finished(run):
            continue
        if not book.claim(run, lease_minutes):
            out.append((run, "", "claimed"))
            continue
        for name in sorted(runs[run]):
            if name not in datasets:
                out.append((run, name, "unknown dataset"))
                continue
            d = datasets[name]
            if d.table.applied(run):
                out.append((run, name, "was merged"))
                continue
            rows = d.read(spark, sorted(runs[run][name]))
            d.table.merge(rows.select(*[F.col(f"`{c}`") for c in d.table.schema.names]), d.policy, tag=run)
            out.append((run, name, "merged"))
        book.finish(run)
    return out
