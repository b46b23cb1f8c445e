"""Sharding by histogram sort: exact byte counts below candidate key boundaries, refined until the splitters are settled.

The key of a document is (hash of its text, hash of its id), so equal texts are neighbours. Each round counts, across all
partitions, the bytes below evenly spaced probes inside the key intervals that still hold an unsettled splitter, and
narrows these intervals; a round brings at most PROBES rows a splitter to the driver. A splitter settles at a boundary
between texts when that is within the tolerance, else inside the group of equal texts, at the nearest boundary between
ids. Rows then get their shard from the splitters and are exchanged once, in slices of a shard, so that neither a shard
nor a hot group meets in one task; a slice's first slot comes from the running sum of the slices' counts.

Defined cases: a null text has no bytes, size 1 and the checksum of the empty text, whose equal it is; rows equal in id
and text have one key and stay in one shard; shards can be empty when there are fewer keys than shards; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.session import stage

SHARDS = 16
#: Part of a mean shard by which a splitter may miss its mark so as to keep equal texts together.
TOLERANCE = 0.01
PROBES = 1024
KEY_BITS = 60
#: Rows that a slice of a shard should hold.
SLICE_ROWS = 500_000
FIRST_BINS = 4096


def hash60(text: Column) -> Column:
    """15 hexadecimal digits of the MD5 as a number in [0, 2**60)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, Column]]:
    body = F.coalesce(F.col(text), F.lit(""))
    return [
        ("size", (F.octet_length(body) + 1).cast("long")), ("h", hash60(body)),
        ("t", hash60(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))),
    ]


def _histogram(keys: DataFrame, column: str, intervals: list[tuple[int, int]], probes: int) -> dict[tuple[int, int], list]:
    """For each interval [low, high] of a key column: (least, most, bytes) of its bins that hold rows, in key order."""
    inside = F.coalesce(*(F.when(F.col(column).between(lo, hi), F.lit(k)) for k, (lo, hi) in enumerate(intervals)))
    wide = [-(-(hi - lo + 1) // probes) for lo, hi in intervals]
    place = F.coalesce(*(F.when(F.col("i") == k, F.expr(f"({column} - {lo}L) div {wide[k]}L")) for k, (lo, _) in enumerate(intervals)))
    rows = keys.withColumn("i", inside).where(F.col("i").isNotNull()).groupBy("i", place.alias("bin"))
    found: dict[tuple[int, int], list] = {x: [] for x in intervals}
    for r in rows.agg(F.sum("size").alias("bytes"), F.min(column).alias("least"), F.max(column).alias("most")).collect():
        found[intervals[r.i]].append((r.least, r.most, int(r.bytes)))
    return {k: sorted(v) for k, v in found.items()}


def _straddling(keys: DataFrame, column: str, marks: dict[int, float], probes: int) -> dict[int, tuple[int, int, int]]:
    """For each mark, in bytes of the keys given: the value of the column that straddles it, the bytes below it and in it."""
    whole = (0, (1 << KEY_BITS) - 1)
    state = {k: (*whole, 0) for k in marks}
    settled: dict[int, tuple[int, int, int]] = {}
    while state:
        bins = _histogram(keys, column, sorted({(lo, hi) for lo, hi, _ in state.values()}), probes)
        for k, (lo, hi, below) in list(state.items()):
            for least, most, held in bins[lo, hi]:
                if marks[k] < below + held:
                    break
                below += held
            state[k] = (least, most, below)
            if least == most:
                settled[k] = (least, below, held)
                del state[k]
    return settled


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[tuple[int, int]]:
    """keys (h, t, size) -> the first key (h, t) of each shard but the first."""
    total = keys.agg(F.sum("size")).first()[0]
    if total is None:
        return []
    marks = {k: int(total) * k / shards for k in range(1, shards)}
    cuts: dict[int, tuple[int, int]] = {}
    inside: dict[int, dict[int, float]] = {}
    for k, (h, below, held) in _straddling(keys, "h", marks, probes).items():
        left, right = marks[k] - below, below + held - marks[k]
        if min(left, right) <= tolerance * int(total) / shards:
            cuts[k] = (h, 0) if left <= right else (h + 1, 0)
        else:
            inside.setdefault(h, {})[k] = left
    for h, rest in inside.items():  # groups of equal texts larger than the tolerance: at most one a splitter
        for k, (t, below, held) in _straddling(keys.where(F.col("h") == h), "t", rest, probes).items():
            cuts[k] = (h, t) if rest[k] - below <= below + held - rest[k] else (h, t + 1)
    return [cuts[k] for k in sorted(cuts)]


def shard_of(cuts: list[tuple[int, int]]) -> Column:
    """The number of splitters at or below a row's key."""
    out = F.lit(0)
    for h, t in cuts:
        out = out + ((F.col("h") > h) | ((F.col("h") == h) & (F.col("t") >= t))).cast("int")
    return out


def sharded(rows: DataFrame, keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """rows (h, t, ...) -> with shard and slot. keys: the same rows' (h, t, size), cheap to read again and again."""
    cuts = splitters(keys, shards, tolerance)
    cell = [shard_of(cuts).alias("shard"), F.expr(f"h div {(1 << KEY_BITS) // FIRST_BINS}L").alias("bin")]
    counted = keys.select("t", *cell)
    # At most FIRST_BINS + shards rows, whatever the input: into how many slices each cell goes.
    parts = counted.groupBy("shard", "bin").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("parts"))
    part = F.floor(F.col("t") / F.lit(float(1 << KEY_BITS)) * F.col("parts")).alias("part")
    where = ["shard", "bin", "part"]
    counts = counted.join(F.broadcast(parts), ["shard", "bin"]).groupBy("shard", "bin", part).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bin", "part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*where, F.coalesce(before, F.lit(0)).alias("before"))
    placed = rows.select("*", *cell).join(F.broadcast(parts), ["shard", "bin"]).withColumn("part", part).drop("parts")
    place = F.row_number().over(Window.partitionBy(*where).orderBy("h", "t")) - 1
    return placed.withColumn("place", place).join(starts, where).withColumn("slot", (F.col("before") + F.col("place")).cast("long")).drop("bin", "part", "place", "before")


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of docs, then shard and slot (with a trailing _ where docs has such names)."""
    names = docs.columns
    columns = dict(keyed(docs, doc_id, text))
    keys = stage(docs.select(*(c.alias(k) for k, c in columns.items())))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), columns["h"].alias("h"), columns["t"].alias("t"))
    out = sharded(packed, keys, shards, tolerance)
    return out.select(*(F.col(f"doc.`{c}`") for c in names), *(F.col(n).alias(_free(n, names)) for n in ("shard", "slot")))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def assignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row for each document."""
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32")
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), checksum, *(c.alias(k) for k, c in keyed(docs, doc_id, text))))
    return sharded(rows, rows.select("h", "t", "size"), shards, tolerance).drop("h", "t")
