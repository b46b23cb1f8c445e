"""Small helpers for row-wise work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as the empty text."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def code_points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))


def by_batch(fn):
    """Adapt ``fn(RecordBatch) -> RecordBatch`` for ``mapInArrow``; empty batches are skipped."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def map_rows(df: DataFrame, fn, more: list[StructField] = ()) -> DataFrame:
    """``mapInArrow`` over all columns of df, whatever their names; the result has these columns and ``more``."""
    names = [f"c{i}" for i in range(len(df.columns))]
    fields = [StructField(n, f.dataType) for n, f in zip(names, df.schema.fields, strict=True)]
    out = df.toDF(*names).mapInArrow(fn, StructType([*fields, *more]))
    return out.toDF(*df.columns, *(f.name for f in more))
