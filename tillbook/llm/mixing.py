"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Sources take shares of ``total`` times all words by weight; a target stops at ``most`` times its source's size and the
excess is shared again by weight, which is the level where the sum of min(most * size, level * weight) meets the total.
Within a source each document is expected target / size times. These expectations are summed in the order of size (then
of a hash of the id), one random offset a source is added, and a document is taken once for each whole number that its
step of the sum crosses. As the order goes by size, the words taken follow the target closely.

The prefix sum needs no task with a whole source: documents are ranked in groups of one (source, size, slice of the
hash), and the groups' offsets come from running sums over counts, over the sizes of a source and the slices of a size.

Defined cases: a null text has no words; a null source is a source of its own, the last; a source without words has a
target of zero and is not taken; repeated rows are ranked in any order, being equal; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
TOTAL, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
#: Hexadecimal digits of the hash that divide a (source, size) group: 256 slices.
SLICE_DIGITS = 2


def unit(text: Column) -> Column:
    """A number in [0, 1) from the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """sizes (source, source_size) -> with target and offset. One row for each source."""
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (number % len(weights) + 1).cast("int"))
    out = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # Sources in the order in which a rising level caps them; those from here on share what the capped ones leave. Past the
    # first that fits the levels fall, so the largest of those that fit is the one that holds.
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (total * F.sum("source_size").over(whole) - capped) / behind
    out = out.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    out = out.withColumn("final", F.max(F.when(F.col("fits"), F.col("level"))).over(whole))
    target = F.least("cap", F.coalesce(F.col("final") * F.col("weight"), "cap"))
    offset = unit(F.concat(F.lit(SEED), F.when(F.col("source").isNull(), ":null").otherwise(F.concat(F.lit("="), "source"))))
    return out.select("source", "source_size", target.alias("target"), offset.alias("offset"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """All columns of docs in a struct ``doc``, and size, source_size, target, copies. One row for each document."""
    spread = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), spread.alias("spread"),
    ).withColumns({"slice": F.substring("spread", 1, SLICE_DIGITS), "known": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit(""))})
    key = ["known", "name", "size", "slice"]
    counts = rows.groupBy("source", *key).agg(F.count("*").alias("n"))
    targets = source_targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, total, most)
    back = (Window.unboundedPreceding, -1)
    by_size = counts.groupBy("known", "name", "size").agg(F.sum("n").alias("n"))
    smaller = F.sum("n").over(Window.partitionBy("known", "name").orderBy("size").rowsBetween(*back))
    by_size = by_size.select("known", "name", "size", F.coalesce(smaller, F.lit(0)).alias("smaller"))
    same = F.sum("n").over(Window.partitionBy("known", "name", "size").orderBy("slice").rowsBetween(*back))
    starts = counts.withColumn("same", F.coalesce(same, F.lit(0))).join(by_size, ["known", "name", "size"])
    starts = starts.select(*key, (F.col("smaller") + F.col("same")).alias("before"))
    targets = targets.withColumns({"known": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit(""))}).drop("source")
    starts = starts.join(targets, ["known", "name"])
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("spread", F.col(f"doc.`{doc_id}`"))))
    ranked = ranked.join(starts, key)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = F.floor((F.col("before") + F.col("rank")) * each + F.col("offset"))
    copies = upto - F.floor((F.col("before") + F.col("rank") - 1) * each + F.col("offset"))
    return ranked.select("doc", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns."""
    taken = mixed(docs, **options).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return taken.select(*(F.col(f"doc.`{c}`") for c in docs.columns))
