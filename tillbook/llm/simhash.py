"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into three segments. Two fingerprints that differ in at most four bits differ in at most one bit of
some segment, so that segment equals the other's once the differing bit is a wildcard: each fingerprint is indexed under
(segment, wildcard position, remaining bits), 64 keys in all. An equality join on these keys finds the candidates; a pair
is taken in one key only (the first segment with at most one differing bit, at that bit) and verified by its bit distance.
Distinct fingerprints are joined, never documents, so a group of copies counts once.

Keys with more than ``HOT_BUCKET`` fingerprints are not joined pairwise. Fingerprints in them go through midpoints: two
fingerprints within four bits have a common value within two bits of each, so they meet under one of the
1 + 64 + 2016 values around them, and every fingerprint links to the smallest one around that value. These links are as
many as the fingerprints, not their pairs. Two members of such a meeting are at most four bits apart, so no false link
arises.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; the component of documents without
any id is null; repeated rows share fingerprint and component; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tillbook.llm.arrow import LOWER, by_batch, map_rows, utf8
from tillbook.llm.components import stars
from tillbook.session import stage

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: First bit and width of each segment; with three, one differs by at most one bit.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HOT_BUCKET = 2000
WIDEST = 22
#: Shingles whose bits are summed at a time.
SLICE = 50_000


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest, n = xxhash.xxh64_intdigest, len(starts)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        part = hashes[at : at + SLICE].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp", size: int = SHINGLE) -> DataFrame:
    """All columns and the fingerprint as a signed 64-bit number."""
    at = docs.columns.index(text)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, size) for t in utf8(batch.column(at))], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, name])

    return map_rows(docs, by_batch(rows), [StructField(name, LongType())])


def _variants(prints: DataFrame) -> DataFrame:
    """(key, fp): 64 rows for each fingerprint; key is the wildcard's position and the segment's bits with that bit zero."""
    keys = []
    for first, width in SEGMENTS:
        for bit in range(width):
            rest = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)).cast("long"))
            keys.append(rest.bitwiseOR(F.lit((first + bit) << WIDEST).cast("long")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _taken_at(x: Column) -> Column:
    """The wildcard under which a pair with differing bits x is taken: in the first segment with at most one of them."""
    taken = F.lit(None).cast("int")
    for first, width in reversed(SEGMENTS):
        part = F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        at = first + F.bit_count(part - 1)  # of a single bit: its position
        taken = F.when(part == 0, first).when(F.bit_count(part) == 1, at).otherwise(taken)
    return taken


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _balls(prints: DataFrame, radius: int) -> DataFrame:
    """(key, fp): every value within radius bits of each fingerprint."""
    masks = (sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r))
    flips = F.expr(f"array({', '.join(f'{_signed(m)}L' if m != 1 << 63 else 'shiftleft(1L, 63)' for m in masks)})")
    return prints.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))


def links(prints: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """(a, b) between distinct fingerprints, with the same components as all pairs at most max_bits apart."""
    if max_bits not in (0, 2, 4):  # three segments serve up to five bits, midpoints even numbers
        raise ValueError("max_bits must be 0, 2 or 4")
    variants = _variants(prints)
    crowds = stage(variants.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    crowded = variants.join(crowds, "key", "left_semi").select("fp").distinct()
    some = not crowds.isEmpty()
    cold = variants.join(crowds, "key", "left_anti") if some else variants
    x = F.col("fp").bitwiseXOR(F.col("other"))
    near = (F.col("fp") < F.col("other")) & (F.bit_count(x) <= max_bits) & (_taken_at(x) == F.shiftright("key", WIDEST))
    # Spark takes exploded rows for as small as what they come from, so it would send them to the driver to broadcast them.
    pairs = cold.join(cold.select(F.col("key").alias("k"), F.col("fp").alias("other")).hint("merge"), (F.col("key") == F.col("k")) & near)
    found = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if not some:
        return found
    balls = _balls(crowded, max_bits // 2)
    centres = balls.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return found.unionByName(balls.join(centres.hint("merge"), "key").where("fp <> b").select(F.col("fp").alias("a"), "b"))


def classes(prints: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """prints (fp, doc_id) -> (fp, label, component_id, keeper): one row for each fingerprint.

    label is the smallest fingerprint reachable, component_id the smallest id reachable, keeper the fingerprint of that id.
    """
    own = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("own")))
    star = stars(links(own.select("fp"), max_bits, hot)).withColumnsRenamed({"a": "fp", "b": "label"})
    labelled = own.join(star, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    best = labelled.groupBy("label").agg(F.min(F.struct(F.col("own").isNull(), "own", "fp")).alias("best"))
    return labelled.join(best, "label").select("fp", "label", F.col("best.own").alias("component_id"), F.col("best.fp").alias("keeper"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = stage(with_fingerprint(slim, size=size).select("doc_id", "fp"))
    found = classes(prints, max_bits, hot)
    fingerprint_hex = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(found, "fp", "left").select("doc_id", fingerprint_hex, "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """The document with the smallest id of each component, with all its columns; of repeated rows, one."""
    name = "fp"
    while name in docs.columns:
        name += "_"
    prints = stage(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), size=size).select("doc_id", "fp"))
    keepers = classes(prints, max_bits, hot).where("fp = keeper").select(F.col("component_id").alias(f"{name}_id"), F.col("fp").alias(f"{name}_kept"))
    marked = with_fingerprint(docs, text, name, size)
    kept = marked.join(keepers, marked[doc_id].eqNullSafe(F.col(f"{name}_id")) & (F.col(name) == F.col(f"{name}_kept")))
    once = Window.partitionBy(f"{name}_id", f"{name}_kept").orderBy(F.hash(*[F.col(f"`{c}`") for c in docs.columns if c in (doc_id, text)]))
    return kept.withColumn(f"{name}_n", F.row_number().over(once)).where(F.col(f"{name}_n") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
