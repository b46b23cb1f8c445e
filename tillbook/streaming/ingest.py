"""Incremental ingest of dropped files as a stream with an idempotent merge, with or without state per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType, TimestampType

from tillbook.operators.core import keep_one
from tillbook.session import stage
from tillbook.sources.versions import VersionedTable
from tillbook.sources.writers import keep_last, replace_units, row_signature, upsert


def ingest_files(
    spark: SparkSession, inbox: str, schema: StructType, target: str, keys: Sequence[str], by: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame], order: Sequence, checkpoint: str, archive: str | None = None,
    valid: Column | None = None, whole: Column | None = None, files_per_batch: int = 100, fmt: str = "parquet",
) -> None:
    """Process all files not seen yet and stop (an hourly job calls it again with the same checkpoint).

    Files are micro-batches. By default a row per key is kept, of one batch the first by ``order``; a later batch
    corrects an earlier one, however late it comes. With ``whole``, a version expression, ``keys`` name a unit such as
    an order, and all its lines are replaced by those of its newest version in the batch. Rows that are not ``valid``
    (such as those with a bad date) are left out. Replaying a batch after a failure gives the same table. ``archive``
    moves files that earlier calls have finished away.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch), "recursiveFileLookup": "true"}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    stream = prepare(spark.readStream.format(fmt).schema(schema).options(**options).load(inbox))
    if valid is not None:
        stream = stream.where(F.coalesce(valid, F.lit(False)))

    def merge(batch: DataFrame, batch_id: int) -> None:
        if whole is not None:
            replace_units(spark, target, batch, keys, by, whole)
        else:
            upsert(spark, target, keep_one(batch, keys, order), keys, by, order)

    query = (
        stream.writeStream.foreachBatch(merge).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()


#: What the state of a bucket holds of each of its keys: signature (32 bytes) and version of the row delivered last, and when (ms).
STATE = "keys array<string>, signatures binary, versions binary, seen binary"
#: Keys lie in this many buckets by their hash; a bucket is one call of the state function, which holds its share of the keys.
BUCKETS = 4096


def changes(stream: DataFrame, keys: Sequence[str], version: str, forget_ms: int | None, buckets: int = BUCKETS) -> DataFrame:
    """Of each key the newest row of a batch, if it says something new: keyed state drops what was delivered before.

    A row is dropped if it is older than the key's last one or equals it. A row that returns to an earlier content is a
    change again. State that has seen nothing for ``forget_ms`` is let go; a later repetition then passes, and the merge
    makes nothing of it. The state of the keys lies in ``buckets``, so a call is paid per bucket, not per key; a batch writes
    the state of the buckets it falls in. A checkpoint goes with the number of its buckets.
    """
    fields = stream.schema.fields
    packed = [_as_text(f).alias(f"p{i}") for i, f in enumerate(fields)]
    names = [f"p{i}" for i in range(len(fields))]
    signed = stream.select(*packed, F.unhex(row_signature(stream.columns)).alias("_signature"), F.col(version).cast("long").cast("string").alias("_version"))
    signed = signed.withColumn("_key", F.to_json(F.array(*[f"p{stream.columns.index(k)}" for k in keys])))
    signed = signed.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    timeout = GroupStateTimeout.NoTimeout if forget_ms is None else GroupStateTimeout.ProcessingTimeTimeout

    # Nested, so that they travel with the function: tasks need not have this package.
    def _packed(known: dict[str, tuple[bytes, int, int]]) -> tuple:
        signatures, versions, seen = zip(*known.values(), strict=True)
        return list(known), b"".join(signatures), np.array(versions, "<i8").tobytes(), np.array(seen, "<i8").tobytes()

    def _unpacked(state: tuple) -> dict[str, tuple[bytes, int, int]]:
        keys, signatures, versions, seen = state
        parts = [bytes(signatures[at : at + 32]) for at in range(0, len(signatures), 32)]
        return dict(zip(keys, zip(parts, *(np.frombuffer(x, "<i8").tolist() for x in (versions, seen)), strict=True), strict=True))

    def newest(bucket, frames: Iterator, state: GroupState) -> Iterator:
        best, known = {}, _unpacked(state.get) if state.exists else {}
        if not state.hasTimedOut:
            for frame in frames:
                columns = [frame[c].tolist() for c in ("_key", "_version", "_signature", *names)]
                for key, at, signature, *row in zip(*columns, strict=True):
                    place = (-(1 << 62) if at is None else int(at)), bytes(signature)
                    if key not in best or place > best[key][0]:
                        best[key] = place, row
        now, fresh = state.getCurrentProcessingTimeMs() if forget_ms is not None else 0, []
        if forget_ms is not None:
            known = {k: v for k, v in known.items() if k in best or v[2] + forget_ms > now}
        for key, ((at, signature), row) in best.items():
            last, version, _ = known.get(key, (None, None, None))
            if last is None or (at >= version and signature != last):
                last, version = signature, at
                fresh.append(row)
            known[key] = last, version, now
        if known:
            state.update(_packed(known))
            if forget_ms is not None:
                state.setTimeoutDuration(max(1, min(v[2] for v in known.values()) + forget_ms - now))
        elif state.exists:
            state.remove()
        if fresh:
            yield pd.DataFrame(fresh, columns=names, dtype=object)

    out = StructType([StructField(n, StringType()) for n in names])
    fresh = signed.groupBy("_bucket").applyInPandasWithState(newest, out, STATE, "append", timeout)
    return fresh.select(*[_from_text(F.col(f"p{i}"), f).alias(f.name) for i, f in enumerate(fields)])


def _as_text(field: StructField) -> Column:
    """A value as text, exactly: data frames in Python would turn whole numbers with nulls into floats."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        raise ValueError(f"{field.name}: only plain columns")
    if isinstance(field.dataType, TimestampType):
        c = F.unix_micros(c)
    return F.base64(c) if isinstance(field.dataType, BinaryType) else c.cast("string")


def _from_text(c: Column, field: StructField) -> Column:
    if isinstance(field.dataType, TimestampType):
        return F.timestamp_micros(c.cast("long"))
    return F.unbase64(c) if isinstance(field.dataType, BinaryType) else c.cast(field.dataType)


class StatefulIngest:
    """Files of keyed rows into a versioned table, with state per key and late rows kept aside.

    ``changes`` drops what a key's state knows; the rest of a batch is merged into ``table`` under the batch as tag, so a
    batch that is run again after a failure finds its tag and is left. Rows of a day more than ``late_days`` before the newest
    day of earlier batches are late: closed days are not reopened by every batch, the rows go into the table ``late`` with
    their batch, and ``merge_late`` merges all of them at once. ``table`` has the column ``changed_in``, the batch that
    changed a row last; ``late`` has it too and is partitioned by it, and so does ``days``, which keeps each batch's newest day.
    """

    def __init__(
        self, spark: SparkSession, inbox: str, schema: StructType, table: VersionedTable, late: VersionedTable, days: VersionedTable, keys: Sequence[str], day: str,
        version: str, checkpoint: str, late_days: int = 7, forget_ms: int | None = None, files_per_batch: int = 1000, fmt: str = "parquet",
        prepare: Callable[[DataFrame], DataFrame] = lambda s: s,
    ):
        self.spark, self.inbox, self.schema, self.table, self.late, self.days = spark, inbox, schema, table, late, days
        self.keys, self.day, self.version, self.checkpoint = list(keys), day, version, checkpoint
        self.late_days, self.forget_ms, self.files_per_batch, self.fmt, self.prepare = late_days, forget_ms, files_per_batch, fmt, prepare

    def run(self) -> list[dict]:
        """All files not seen yet; per batch that ran how many rows were new, and how many of them late."""
        stream = self.spark.readStream.format(self.fmt).schema(self.schema).options(maxFilesPerTrigger=str(self.files_per_batch), recursiveFileLookup="true").load(self.inbox)
        fresh, report = changes(self.prepare(stream), self.keys, self.version, self.forget_ms), []

        def merge(batch: DataFrame, batch_id: int) -> None:
            rows = stage(batch.withColumn("changed_in", F.lit(batch_id).cast("long")))
            seen = self.days.read().where(F.col("changed_in") < batch_id).agg(F.max("newest")).first()[0]
            late = F.coalesce(F.datediff(F.lit(seen).cast("date"), F.col(self.day).cast("date")) > self.late_days, F.lit(False))
            tag = f"batch-{batch_id}"
            for table, part, how in (
                (self.late, rows.where(late), lambda old, new: new),
                (self.days, rows.agg(F.max(F.col(self.day).cast("date")).cast("string").alias("newest")).withColumn("changed_in", F.lit(batch_id).cast("long")), lambda old, new: new),
                (self.table, rows.where(~late), self._newer),
            ):
                if not table.applied(tag):
                    table.merge(part.select(*table.schema.names), how, tag=tag)
            counts = rows.agg(F.count("*").alias("rows"), F.count_if(late).alias("late")).first()
            report.append({"batch": batch_id, "rows": counts.rows, "late": counts.late})

        query = (
            fresh.writeStream.foreachBatch(merge).outputMode("append").option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        return report

    def _newer(self, old: DataFrame, new: DataFrame) -> DataFrame:
        return keep_last(old, new, self.keys, [F.col("changed_in").desc()])

    def merge_late(self) -> int:
        """Merge the late rows kept aside into the table and empty their partitions; returns their number.

        A row that a later batch has changed since stays as it is. Stopped between the two writes, a second call merges the
        same rows again, to the same table.
        """
        waiting = stage(self.late.read())
        n = waiting.count()
        if n:
            newest = lambda old, new: keep_one(old.unionByName(new), self.keys, [F.col("changed_in").desc()])
            self.table.merge(waiting.select(*self.table.schema.names), newest)
            none = self.spark.createDataFrame([], self.late.schema)
            self.late.replace(none, emptied=waiting.select(*self.late.by).distinct())
        return n
