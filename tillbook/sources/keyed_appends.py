"""Appends of unseen keys to a versioned table, with a filter for each file that says which keys it may hold.

Each write leaves an index beside the table: per file the smallest and largest first key and a Bloom filter over all keys. An
append reads the index first and joins the new keys only with the files that may hold one of them: those whose range meets the
new keys' range and, if the new keys are at most ``MAX_KEYS`` (their hashes then fit a broadcast of 8 bytes each), whose filter
has one of them. Beyond that the ranges alone decide. A file without an index is always read, so what was written by other
means is never overlooked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.session import stage
from tillbook.sources.versions import VersionedTable

#: Keys of an append whose hashes are sent to all tasks: 16 MB.
MAX_KEYS = 2_000_000
#: Bits of a filter for each key, and places of a key in it: about one wrong file in a hundred.
BITS, PLACES = 10, 7
INDEX = "file string, low string, high string, n long, bits binary"


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of 64-bit hashes in a filter: the first half of a hash, stepped on by the second."""
    first, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(PLACES):
        yield ((first + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64)


def _filter(hashes: np.ndarray) -> bytes:
    bits = max(64, BITS * len(hashes)) // 8 * 8
    out = np.zeros(bits // 8, np.uint8)
    for at in _places(hashes, bits):
        np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out.tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    """Whether a filter has any of the hashes."""
    table = np.frombuffer(bits, np.uint8)
    alive = hashes
    for k in range(PLACES):
        if not len(alive):
            return False
        at = list(_places(alive, len(table) * 8))[k]
        alive = alive[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return bool(len(alive))


def key_hash(keys: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys])


def index_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INDEX of the files that rows come from. A file's rows arrive in one task, sorted by file, as far as files are not split."""
    first = F.col(f"`{keys[0]}`").cast("string")
    slim = rows.select(F.col("_metadata.file_path").alias("file"), first.alias("key"), key_hash(keys).alias("h"))
    ranges = slim.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"), F.count_if(F.col("key").isNull()).alias("nulls"))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [name], "bits": pa.array([_filter(np.concatenate(held))], pa.binary())})

        for batch in batches:
            files, h = batch.column(0), batch.column(1).to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, np.array(files[1:].to_pylist()) != np.array(files[:-1].to_pylist())]) if batch.num_rows else []
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if files[int(start)].as_py() != name:
                    if held:
                        yield out()
                    name, held = files[int(start)].as_py(), []
                held.append(h[start:end])
        if held:
            yield out()

    filters = slim.select("file", "h").repartition("file").sortWithinPartitions("file").mapInArrow(build, "file string, bits binary")
    # Without a range (a null among the first keys) a file is a candidate for every range.
    limit = lambda c: F.when(F.col("nulls") == 0, F.col(c)).alias(c)
    return ranges.join(filters, "file").select("file", limit("low"), limit("high"), "n", "bits")


class KeyedAppends:
    """Appends to ``table`` of rows whose ``keys`` it does not hold."""

    def __init__(self, table: VersionedTable, keys: Sequence[str]):
        self.table, self.keys, self.spark = table, list(keys), table.spark

    def _index(self, write: str) -> str:
        return f"{self.table.path}/index/w={write}"

    def _write_index(self, write: str) -> None:
        p, fs = self.table._hadoop(f"{self.table.path}/data/w={write}")
        if fs.exists(p):  # an append of no rows leaves no folder
            index_rows(self.table.files_of(write), self.keys).write.parquet(self._index(write))

    def candidates(self, new: DataFrame) -> DataFrame:
        """(file, w) of the current files that may hold a key of ``new``; files without an index have a null one, for all of their write."""
        state = stage(self.table.state())
        writes = [r[0] for r in state.select("w").distinct().collect()]
        indexed = [w for w in writes if self._has_index(w)]
        out = state.select("w").distinct().where(~F.col("w").isin(indexed)).select(F.lit(None).cast("string").alias("file"), "w")
        if not indexed:
            return out
        index = self.spark.read.schema(INDEX).option("basePath", f"{self.table.path}/index").parquet(*[self._index(w) for w in indexed])
        index = index.withColumn("w", F.regexp_extract("_metadata.file_path", r"/w=([0-9a-f]+)/", 1))
        first = F.col(f"`{self.keys[0]}`").cast("string")
        ends = new.agg(F.min(first), F.max(first), F.count("*"), F.count_if(first.isNull())).first()
        if not ends[2]:
            return out.limit(0)
        if not ends[3]:
            index = index.where(F.coalesce((F.col("high") >= ends[0]) & (F.col("low") <= ends[1]), F.lit(True)))
        if ends[2] <= MAX_KEYS:
            hashes = np.array([r[0] for r in new.select(key_hash(self.keys)).distinct().collect()], np.int64).view(np.uint64)
            shared = self.spark.sparkContext.broadcast(hashes)

            def tested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    held = [may_hold(b, shared.value) for b in batch.column(2).to_pylist()]
                    yield batch.filter(pa.array(held, pa.bool_())).select([0, 1])

            index = index.select("file", "w", "bits").mapInArrow(tested, "file string, w string")
        return out.unionByName(index.select("file", "w"))

    def _has_index(self, write: str) -> bool:
        p, fs = self.table._hadoop(f"{self._index(write)}/_SUCCESS")
        return fs.exists(p)

    def held(self, new: DataFrame) -> DataFrame:
        """The keys in the files that may hold one of ``new``: distinct tuples, nulls included."""
        found = stage(self.candidates(new)).collect()  # names of files, as any scan lists them
        files = [r.file for r in found if r.file] + [f"{self.table.path}/data/w={r.w}" for r in found if not r.file]
        if not files:
            return self.spark.createDataFrame([], self.table.schema).select(*[F.col(f"`{k}`") for k in self.keys])
        rows = self.spark.read.schema(self.table.files_of("none").schema).option("basePath", f"{self.table.path}/data").parquet(*_decoded(files))
        return rows.select(*[F.col(f"`{k}`") for k in self.keys]).distinct()

    def append(self, new: DataFrame, tag: str | None = None) -> DataFrame:
        """Append the rows with unseen keys, of several new rows with a key all; returns one row (inserted, duplicated, total)."""
        new, base = stage(new), (self.table.versions() or [0])[-1]
        theirs = self.held(new).withColumnsRenamed({k: f"_held_{i}" for i, k in enumerate(self.keys)}).withColumn("_seen", F.lit(1))
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_held_{i}"))
        done = stage(new.join(theirs, same, "left").select(*[F.col(f"`{c}`") for c in new.columns], "_seen"))
        self.table.append(done.where(F.col("_seen").isNull()), tag, base, self._write_index)
        return done.agg(F.count_if(F.col("_seen").isNull()).alias("inserted"), F.count("_seen").alias("duplicated"), F.count(F.lit(1)).alias("total"))


def _decoded(files: Sequence[str]) -> list[str]:
    from urllib.parse import unquote

    return [unquote(f) for f in files]
