"""Row and order keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.clean import text
from tillbook.operators.core import AUTO, running


def surrogate_key(columns: Sequence[str], length: int = 16) -> Column:
    """First hex digits of the sha1 of the '|'-joined natural key."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, length)


PK_COLUMNS = ("sale_date", "source", "store", "platform", "order_id", "item_seq")


def unified_pk(columns: Sequence[str] = PK_COLUMNS) -> Column:
    """md5 of the trimmed key columns, null as empty."""
    return F.md5(F.concat_ws("|", *[text(c) for c in columns]))


def row_hash(columns: Sequence[str], length: int = 12) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, length)


def sub_order_id(df: DataFrame, order_id: str, order: Sequence, hash_col: str | None = None, hot=AUTO) -> DataFrame:
    """order_position[_hash4], unique per line even for identical lines."""
    out = running(df, [order_id], order, {"_seq": ("count", None)}, hot=hot)
    parts = [F.col(order_id).cast("string"), F.col("_seq").cast("string")]
    if hash_col:
        parts.append(F.substring(hash_col, 1, 4))
    return out.withColumn("sub_order_id", F.concat_ws("_", *parts)).drop("_seq")
