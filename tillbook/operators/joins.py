"""Joins of the sales domain.

Lookups are reduced to one row per key before they are joined, and the match
itself is done on distinct keys where the fact side is large, so no join fans
out. Range and nearest matches are written as equi joins or as windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.operators.core import AUTO, col, hot_keys, keep_one, null_safe, running, unique_by

UNASSIGNED = "미배정"


def last_token(c) -> Column:
    return F.element_at(F.split(F.trim(col(c)), r"\s+"), -1)


def last_two_tokens(c) -> Column:
    parts = F.split(F.trim(col(c)), r"\s+")
    return F.concat_ws(" ", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)))


def heads_with_lines(heads: DataFrame, items: DataFrame, on: Sequence[str], hot=AUTO) -> DataFrame:
    """Headers LEFT JOIN lines on equally named keys, as an inner join and the headers without lines.

    Adaptive skew handling can split either side of an inner join but not the right side of an outer one, and the
    header that holds a third of all lines is on the right. The keys of the lines are made unique before the rest.
    Without hot groups (``hot`` is None) it is a plain left join, which leaves the rows dealt by the keys.
    """
    if hot is None:
        both = heads.join(items, list(on), "left")
        return both.select(*on, *[c for df in (items, heads) for c in df.columns if c not in on])
    alone = heads.join(items.select(*on).distinct(), list(on), "left_anti")
    return items.join(heads, list(on)).unionByName(alone, allowMissingColumns=True)


def order_item_join(heads: DataFrame, items: DataFrame, on: dict[str, str], keep_unmatched: bool = True) -> DataFrame:
    """Header x items on header column -> item column; unmatched headers stay (refunds) or are dropped by rule."""
    same = [F.col(h) == F.col(i) for h, i in on.items()]
    both = items.join(heads, same).select(*heads.columns, *items.columns)
    if not keep_unmatched:
        return both
    alone = heads.join(items.select(*on.values()).distinct(), same, "left_anti")
    return both.unionByName(alone, allowMissingColumns=True)


def dim_enrich(facts: DataFrame, dim: DataFrame, name: str, dim_name: str, attrs: Sequence[str]) -> DataFrame:
    """Attributes by the last token of the store name; a known key wins over the old value."""
    look = keep_one(dim.withColumn("_key", last_token(dim_name)), ["_key"], [dim_name]).select(
        "_key", *[F.col(a).alias(f"_new_{a}") for a in attrs]
    )
    out = facts.withColumn("_key", last_token(name)).join(look, "_key", "left")
    return out.withColumns(
        {a: F.coalesce(F.col(f"_new_{a}"), F.col(a)) if a in facts.columns else F.col(f"_new_{a}") for a in attrs}
    ).drop("_key", *[f"_new_{a}" for a in attrs])


def cascading_match(facts: DataFrame, dim: DataFrame, name: str, dim_name: str, attrs: Sequence[str]) -> DataFrame:
    """Full name, then last two tokens, then last token; the first stage that hits wins.

    Stages run on the distinct names, the result is joined to the facts once.
    """
    names = facts.select(F.col(name).alias("_name")).where(F.col(name).isNotNull()).distinct()
    stages = [F.trim(F.col(dim_name)), last_two_tokens(dim_name), last_token(dim_name)]
    matched = names
    for i, key in enumerate(stages, 1):
        look = keep_one(dim.withColumn("_k", key), ["_k"], [dim_name]).select(
            F.col("_k").alias(f"_k{i}"), F.struct(F.lit(i).alias("stage"), *attrs).alias(f"_hit{i}")
        )
        matched = matched.join(look, F.col("_name") == F.col(f"_k{i}"), "left")
    hit = F.coalesce("_hit1", "_hit2", "_hit3")
    matched = matched.select("_name", hit["stage"].alias("match_stage"), *[hit[a].alias(a) for a in attrs])
    return facts.join(matched, facts[name] == matched["_name"], "left").drop("_name")


def manager_refresh_join(df: DataFrame, fresh: DataFrame, key: str, attr: str, default: str = UNASSIGNED) -> DataFrame:
    """Newest assignment wins, then the stored one, then the default."""
    new = fresh.select(key, F.col(attr).alias("_new"))
    return df.join(new, key, "left").withColumn(attr, F.coalesce("_new", attr, F.lit(default))).drop("_new")


def multi_source_daily_join(base: DataFrame, keys: Sequence[str], rights) -> DataFrame:
    """Chain of left joins; each right side is (df, order) and is made unique first."""
    for right, order in rights:
        base = base.join(unique_by(right, keys, order), list(keys), "left")
    return base


def full_outer_reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], reported: str, unified: str, limit: float = 2.0
) -> DataFrame:
    """Difference and error rate of two totals per key; a side without the key counts as 0."""
    from tillbook.functions.numbers import ratio, rnd

    zero = F.lit(0).cast("bigint")
    j = left.join(right, list(keys), "full").select(
        *keys, F.coalesce(reported, zero).alias("reported"), F.coalesce(unified, zero).alias("unified")
    )
    return (
        j.withColumn("difference", F.col("unified") - F.col("reported"))
        .withColumn(
            "error_rate",
            F.coalesce(rnd(ratio(F.abs("difference"), F.abs("reported")) * 100, 2), F.lit(0.0)),
        )
        .withColumn("status", F.when(F.col("error_rate") >= limit, "error").otherwise("ok"))
    )


def calendar_grid(stores: DataFrame, first, last) -> DataFrame:
    """Store x month rows with active / new / closed flags from open and close dates."""
    months = F.explode(
        F.sequence(F.trunc(F.lit(first).cast("date"), "MM"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    )
    g = stores.withColumn("m", months).withColumn("m_end", F.last_day("m"))
    opened, closed = F.col("open_date"), F.col("close_date")
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)
    return g.select(
        F.date_format("m", "yyyy-MM").alias("ym"), "store", "open_date", "close_date",
        flag((opened <= F.col("m_end")) & (closed.isNull() | (closed >= F.col("m")))).alias("is_active"),
        flag(opened.between(F.col("m"), F.col("m_end"))).alias("is_new"),
        flag(closed.between(F.col("m"), F.col("m_end"))).alias("is_closed"),
    )


def range_join_launch(sales: DataFrame, launches: DataFrame, key: str = "item_id", days: int = 30) -> DataFrame:
    """Quantity and revenue in launch date..+days per product, 0 when nothing sold.

    Sales are first summed per product and day, then joined on the product.
    """
    daily = sales.groupBy(key, "sale_date").agg(F.sum("qty").alias("_q"), F.sum("total_price").alias("_r"))
    hit = launches.join(daily, key).where(
        F.col("sale_date").between(F.col("launch_date"), F.date_add("launch_date", days))
    )
    sums = hit.groupBy(key).agg(F.sum("_q").alias(f"qty_{days}d"), F.sum("_r").alias(f"revenue_{days}d"))
    return launches.join(sums, key, "left").fillna(0, [f"qty_{days}d", f"revenue_{days}d"])


def nearest_asof(
    left: DataFrame, quotes: DataFrame, key: str, target: Column, tolerance: int, out: str, day="base_date", price="price"
) -> DataFrame:
    """Price of the quote nearest to ``target`` within +-tolerance days (earlier wins ties; on one day the smallest price).

    Quotes and asked days are one set of rows, ordered by day; each asked day carries the last quote up to it and, in the order
    turned round, the first one from it on. Nothing is multiplied by the tolerance, and hot keys go in slices (``core.running``).
    """
    probe = left.select(key, day).distinct().withColumn("_d", target)
    found = quotes.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    found = found.groupBy(F.col(key), F.col(day).alias("_d")).agg(F.min(F.struct(F.col(price).alias("p"))).alias("_p"))
    found = found.select(key, "_d", F.lit(0).alias("_asked"), F.struct(F.col("_d").alias("d"), F.col("_p.p").alias("p")).alias("_q"))
    both = found.unionByName(probe.where(F.col(key).isNotNull() & F.col("_d").isNotNull()).withColumn("_asked", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_back", -F.datediff("_d", F.lit("1970-01-01").cast("date")))
    hot = hot_keys(both, [key])
    for order, name in (("_d", "_before"), ("_back", "_after")):
        both = running(both, [key], [order, "_asked", day], {name: ("last", "_q")}, hot=hot)
    gap = lambda q: F.when(F.abs(F.datediff(F.col(q)["d"], "_d")) <= tolerance, F.abs(F.datediff(F.col(q)["d"], "_d")))
    earlier = gap("_before").isNotNull() & (gap("_after").isNull() | (gap("_before") <= gap("_after")))
    best = F.when(earlier, F.col("_before")["p"]).when(gap("_after").isNotNull(), F.col("_after")["p"])
    return left.join(both.where(F.col("_asked") == 1).select(key, day, best.alias(out)), [key, day], "left")


def event_window_join(
    actions: DataFrame, daily: DataFrame, key: str, metrics: dict[str, str], rows: int = 7, day="sale_date"
) -> DataFrame:
    """Sum or mean of the last ``rows`` daily rows before and the first ``rows`` after each action date.

    Every daily row carries its trailing and leading window; an action takes the
    one of the nearest daily row on each side, found by a last / first window
    over the two row sets together, so nothing is multiplied out.
    """
    w = Window.partitionBy(key).orderBy(day)
    fns = {"sum": F.sum, "mean": F.avg}

    def frame(lo, hi):
        return F.struct(*[fns[f](m).over(w.rowsBetween(lo, hi)).alias(m) for m, f in metrics.items()])

    marked = daily.select(
        key, F.col(day).alias("_d"), F.lit(1).alias("_kind"),
        frame(-(rows - 1), 0).alias("_back"), frame(0, rows - 1).alias("_ahead"),
        F.struct(*metrics).alias("_spot"),
    )
    asked = actions.withColumn("_d", F.col("action_date")).withColumn("_kind", F.lit(0))
    both = asked.unionByName(marked, allowMissingColumns=True)
    # Range frames on the day number leave out rows of the action date itself. Looking ahead is looking back over the
    # negated day number: a frame that only grows is one pass, one that only shrinks is evaluated anew for each row.
    number = F.datediff("_d", F.lit("1970-01-01").cast("date"))
    span, back = Window.partitionBy(key).orderBy(number), Window.partitionBy(key).orderBy(-number)
    both = both.withColumns(
        {
            "_prev": F.last("_back", ignorenulls=True).over(span.rangeBetween(Window.unboundedPreceding, -1)),
            "_next": F.last("_ahead", ignorenulls=True).over(back.rangeBetween(Window.unboundedPreceding, -1)),
            "_same": F.first("_spot", ignorenulls=True).over(span.rangeBetween(0, 0)),
        }
    )
    return both.where(F.col("_kind") == 0).select(
        *actions.columns,
        *[F.col(f"_prev.{m}").alias(f"{m}_prev") for m in metrics],
        *[F.col(f"_next.{m}").alias(f"{m}_next") for m in metrics],
        *[F.col(f"_same.{m}").alias(f"{m}_spot") for m in metrics],
    )


def anti_new_keys(candidates: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known yet."""
    return candidates.join(known.select(*keys), list(keys), "left_anti")


def snapshot_change_detect(new: DataFrame, latest: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """New rows and rows that differ from the latest version on a tracked column."""
    old = latest.select(*keys, F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in tracked])
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    kind = F.when(F.col("_known").isNull(), "신규").when(~same, "변경")
    return (
        new.join(old, list(keys), "left")
        .withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .drop("_known", *[f"_old_{c}" for c in tracked])
    )


def code_to_name_map(df: DataFrame, master: DataFrame, code: str, name: str) -> DataFrame:
    """Canonical name by code; rows without a code get the code of their name, else an md5 of it."""
    by_code = keep_one(master, ["code"], ["name"]).select(F.col("code").alias(code), F.col("name").alias("_canon"))
    by_name = keep_one(master, ["name"], ["code"]).select(F.col("name").alias(name), F.col("code").alias("_code"))
    out = df.join(by_name, name, "left")
    out = out.withColumn(code, F.coalesce(F.nullif(F.col(code), F.lit("")), "_code", F.md5(F.col(name)))).drop("_code")
    return out.join(by_code, code, "left").withColumn(name, F.coalesce("_canon", name)).drop("_canon")


def missing_key_grid(stores: DataFrame, first, last, present: DataFrame, no_data: DataFrame | None = None) -> DataFrame:
    """(day, store) pairs expected from the opening date on but neither collected nor marked as empty."""
    lo = F.greatest(F.lit(first).cast("date"), F.col("open_date"))
    hi = F.lit(last).cast("date")
    grid = stores.where(lo <= hi).select("store", F.explode(F.sequence(lo, hi)).alias("sale_date"))
    out = grid.join(present.select("store", "sale_date").distinct(), ["store", "sale_date"], "left_anti")
    if no_data is not None:
        out = out.join(no_data.select("store", "sale_date").distinct(), ["store", "sale_date"], "left_anti")
    return out


def refund_inherit(orders: DataFrame, by_amount: Sequence[str], by_receipt: Sequence[str]) -> DataFrame:
    """Refunds without a menu name take that of the first order with the same amount, else of the same receipt.

    ``orders`` has one row per order with menu_name (null for refunds), abs_total and order_seq.
    """
    named = orders.where(F.col("menu_name").isNotNull())
    amount_keys = [*by_amount, "abs_total"]
    a = keep_one(named.where(F.col("abs_total") > 0), amount_keys, ["order_seq"]).select(
        *amount_keys, F.col("menu_name").alias("_by_amount")
    )
    r = keep_one(named, by_receipt, ["order_seq"]).select(*by_receipt, F.col("menu_name").alias("_by_receipt"))
    return (
        orders.join(a, amount_keys, "left")
        .join(r, list(by_receipt), "left")
        .withColumn("menu_name", F.coalesce("menu_name", "_by_amount", "_by_receipt"))
        .drop("_by_amount", "_by_receipt")
    )


# Time slot names.
LUNCH, DINNER = "점심", "저녁"


def time_slot_inherit(df: DataFrame, match: Sequence[str], hour: Column, amount: str = "total_price") -> DataFrame:
    """Lunch / dinner by hour; hour 0 takes the slot of a matching row, the day's larger slot, else dinner."""
    slot = F.when((hour >= 6) & (hour < 16), LUNCH).when((hour >= 16) & (hour < 24), DINNER).when(
        (hour > 0) & (hour < 6), F.lit(None)
    )
    rows = df.withColumn("_slot", slot)
    known = rows.where(F.col("_slot").isNotNull())
    look = known.groupBy("sale_date", *match).agg(F.min("_slot").alias("_matched"))
    sizes = known.groupBy("sale_date", "_slot").agg(F.sum(F.abs(F.col(amount))).alias("_amt"))
    day = sizes.groupBy("sale_date").agg(F.max(F.struct("_amt", "_slot")).alias("_big")).select(
        "sale_date", F.col("_big._slot").alias("_default")
    )
    return (
        rows.join(look, ["sale_date", *match], "left")
        .join(day, "sale_date", "left")
        .withColumn("time_slot", F.coalesce("_slot", "_matched", "_default", F.lit(DINNER)))
        .drop("_slot", "_matched", "_default")
    )


def unmatched_reason(codes: DataFrame, master: DataFrame, code: str = "code") -> DataFrame:
    """Why a code is not a main product: unknown, excluded, or no main candidate."""
    m = master.select(F.col("code").alias(code), F.lit(1).alias("_in"), "is_main_candidate", "exclude_check")
    reason = (
        F.when(F.col("_in").isNull(), "not_registered")
        .when(F.col("exclude_check") == "Y", "excluded")
        .when(F.coalesce(F.col("is_main_candidate") != "Y", F.lit(True)), "not_main_candidate")
    )
    return (
        codes.select(code).distinct().join(m, code, "left").withColumn("reason", reason)
        .where(F.col("reason").isNotNull()).select(code, "reason")
    )


def new_item_draft(items: DataFrame, control: DataFrame, label: Column) -> DataFrame:
    """Control table plus a draft row, flagged for review, for every item it lacks."""
    drafts = (
        items.select("item_name").distinct().join(control.select("item_name").distinct(), "item_name", "left_anti")
        .select("item_name", label.alias("is_valid"), F.lit("").alias("store"), F.lit("Y").alias("review_needed"),
                F.lit("auto_rule").alias("classified_by"))
    )
    both = control.unionByName(drafts)
    return keep_one(both, ["item_name", "store"], [F.when(F.upper(F.trim("is_valid")) == "N", 0).otherwise(1)])
