"""Versioned master tables: products, policies, visit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.clean import blank_to_null
from tillbook.operators.core import keep_one
from tillbook.operators.joins import snapshot_change_detect
from tillbook.operators.matching import token_overlap_match
from tillbook.operators.order_lines import is_latest_flag
from tillbook.session import stage

KEYS = ("source", "code")


def latest_version(master: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return keep_one(master, keys, [F.col("updated_at").desc(), F.col("version").desc()])


def product_master_update(master: DataFrame, incoming: DataFrame, tracked: Sequence[str], label: Column, now) -> DataFrame:
    """Append new and changed products as new versions and mark the newest one.

    A changed product keeps its confirmed label and exclusion; a new one gets the rule label and waits for review.
    """
    old = latest_version(master)
    changes = snapshot_change_detect(incoming, old, KEYS, tracked)
    kept = old.select(*KEYS, F.col("label").alias("_label"), F.col("review_needed").alias("_open"), F.col("exclude_check").alias("_ex"), F.col("version").alias("_v"))
    confirmed = blank_to_null("_label").isNotNull() & (F.col("_open") != "Y")
    rows = changes.join(kept, list(KEYS), "left").withColumns(
        {
            "label": F.when(confirmed, F.col("_label")).otherwise(label),
            "review_needed": F.when(confirmed, "N").otherwise("Y"),
            "exclude_check": F.coalesce("_ex", F.lit("N")),
            "updated_at": F.lit(now).cast("date"), "version": F.coalesce("_v", F.lit(0)) + 1, "approve": F.lit(""),
        }
    )
    cols = [c for c in master.columns if c != "is_latest"]
    return is_latest_flag(master.select(*cols).unionByName(rows.select(*cols)), KEYS, "updated_at", "version")


def apply_review_approvals(master: DataFrame, now) -> DataFrame:
    """Approved versions are appended as confirmed ones; the approval mark is cleared on all versions of the product."""
    cols = [c for c in master.columns if c != "is_latest"]
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    chosen = master.where((up("is_latest") == "Y") & (up("review_needed") == "Y") & (up("approve") == "Y"))
    new = chosen.select(*cols).withColumns(
        {"review_needed": F.lit("N"), "approve": F.lit(""), "updated_at": F.lit(now).cast("date"), "version": F.col("version") + 1}
    )
    marks = chosen.select(*KEYS).distinct().withColumn("_hit", F.lit(True))
    cleared = master.select(*cols).join(marks, list(KEYS), "left").withColumn(
        "approve", F.when(F.col("_hit"), "").otherwise(F.col("approve"))
    )
    return is_latest_flag(cleared.select(*cols).unionByName(new.select(*cols)), KEYS, "updated_at", "version")


def append_unseen_codes(master: DataFrame, lines: DataFrame, source: str, order: Sequence[str], now, label: str = "기타") -> DataFrame:
    """Product codes of receipt lines that the master does not have for the source, appended to wait for review.

    ``lines``: code, name, list_price and the columns of ``order``; of a code the last line gives name and price.
    """
    seen = master.where(F.lower(F.trim("source")) == source.lower()).select(F.trim("code").alias("code")).distinct()
    coded = lines.withColumn("code", F.trim("code")).where(F.coalesce(F.col("code"), F.lit("")) != "")
    last = keep_one(coded.join(seen, "code", "left_anti"), ["code"], [F.col(c).desc() for c in order])
    rows = last.select("code", "name", "list_price").withColumns(
        {
            "source": F.lit(source), "label": F.lit(label), "review_needed": F.lit("Y"), "exclude_check": F.lit("N"), "approve": F.lit(""),
            "updated_at": F.lit(now).cast("date"), "version": F.lit(1),
        }
    )
    cols = [c for c in master.columns if c != "is_latest"]
    return is_latest_flag(master.select(*cols).unionByName(rows.select(*cols)), KEYS, "updated_at", "version")


def finalise_pending(master: DataFrame, source: str, rule: Column, now, threshold: int = 70) -> DataFrame:
    """Products of a source whose newest version waits for review are confirmed: a confirmed version is appended.

    Its label is that of the confirmed products whose names share most tokens with it, where these are enough, else the
    rule's on the name. The master and its newest versions are written out first: the matching reads them many times.
    """
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    master = stage(master)
    newest = stage(latest_version(master))
    pending = newest.where((F.lower(F.trim("source")) == source.lower()) & (up("review_needed") == "Y"))
    examples = newest.where((up("review_needed") != "Y") & blank_to_null("label").isNotNull()).select("name", "label")
    keyed = pending.withColumn("_key", F.concat_ws("\u0001", *KEYS))
    found = token_overlap_match(keyed, examples, "_key", "name", threshold=threshold).select("_key", F.nullif("matched_label", F.lit("")).alias("_found"))
    cols = [c for c in master.columns if c != "is_latest"]
    rows = keyed.join(found, "_key").withColumns(
        {"label": F.coalesce("_found", rule), "review_needed": F.lit("N"), "approve": F.lit(""), "updated_at": F.lit(now).cast("date"), "version": F.col("version") + 1}
    )
    return is_latest_flag(master.select(*cols).unionByName(rows.select(*cols)), KEYS, "updated_at", "version")


def explicit_order(c, order: Sequence[str]) -> Column:
    """Position in a fixed list, unknown values last."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(c))
    return F.when(F.coalesce(pos, F.lit(0)) > 0, pos).otherwise(999)


def policy_consolidate(sources: Sequence[DataFrame], previous: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest policy per platform over all sources, in platform order, marked when its date differs from the last run."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s, allowMissingColumns=True)
    latest = keep_one(rows, ["platform"], [F.col("policy_date").desc(), F.col("title")])
    prev = previous.select("platform", F.col("policy_date").alias("_prev"))
    return latest.join(prev, "platform", "left").select(
        *latest.columns, explicit_order("platform", order).alias("platform_order"),
        F.when(F.col("_prev").eqNullSafe(F.col("policy_date")), "N").otherwise("Y").alias("is_new"),
    )


def visit_log_merge(master: DataFrame, new: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Outer join of the log with new notes; per attribute the first non-blank value, the log's own first."""
    j = master.select(key, *[F.col(a).alias(f"_m_{a}") for a in attrs]).join(
        keep_one(new, [key], list(attrs)).select(key, *[F.col(a).alias(f"_n_{a}") for a in attrs]), key, "full"
    )
    return j.select(key, *[F.coalesce(blank_to_null(f"_m_{a}"), blank_to_null(f"_n_{a}")).alias(a) for a in attrs])
