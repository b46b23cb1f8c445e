"""Line-level operators inside one order.

``item_seq`` is the unique position of a line in its order. A broken export can
put a third of all lines under one order key (a blank receipt number, say), so
every operator goes through ``core.attach`` and ``core.running`` and takes the
hot keys (``hot``) that a job counts once; by default it counts them itself.

The whole-order values of several operators can be attached in one pass: give
their ``*_values`` to ``attach`` (or to ``main_item_segments`` as ``also``) and
call them with ``attached``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.clean import blank_to_null, text
from tillbook.functions.keys import unified_pk
from tillbook.functions.numbers import rnd_int
from tillbook.operators.core import AUTO, attach, by_heat, col, keep_one, running

SEQ = "item_seq"


def item_seq(df: DataFrame, order: Sequence[str], by: Sequence, hot=AUTO) -> DataFrame:
    """1-based position of each line in its order."""
    return running(df, order, by, {SEQ: ("count", None)}, hot=hot)


def representative_values(price, name_match: Column | None = None) -> dict[str, Column]:
    match = F.when(name_match, 0).otherwise(1) if name_match is not None else F.lit(0)
    return {"_best": F.min(F.struct(match.alias("m"), (-F.coalesce(col(price), F.lit(0))).alias("p"), F.col(SEQ).alias("s"), F.col("item_name").alias("n")))}


def representative_row(
    df: DataFrame, order: Sequence[str], price, cancel_value: int = -1, name_match: Column | None = None,
    set_menu: bool = True, attached: bool = False, hot=AUTO,
) -> DataFrame:
    """Menu name and order count on the order's best line: name match, then highest price, then first.

    ``menu_name`` is set on all lines (``set_menu``), ``order_cnt`` is 1 (or the
    cancel value) on the best line only.
    """
    out = df if attached else attach(df, order, representative_values(price, name_match), hot=hot)
    sign = F.when(F.col("sale_type") == "취소", cancel_value).otherwise(1)
    out = out.withColumn("order_cnt", F.when(F.col(SEQ) == F.col("_best.s"), sign).otherwise(0))
    return (out.withColumn("menu_name", F.col("_best.n")) if set_menu else out).drop("_best")


def last_line_values() -> dict[str, Column]:
    return {"_last": F.max(SEQ)}


def order_cnt_last_line(df: DataFrame, order: Sequence[str], attached: bool = False, hot=AUTO) -> DataFrame:
    """1 (or -1 for cancelled) on the last line of the receipt, 0 elsewhere."""
    out = df if attached else attach(df, order, last_line_values(), hot=hot)
    sign = F.when(F.col("sale_type") == "취소", -1).otherwise(1)
    return out.withColumn("order_cnt", F.when(F.col(SEQ) == F.col("_last"), sign).otherwise(0)).drop("_last")


# Words of fee-like and option-like lines, and the floor of the main-line heuristic.
FEE_WORDS = "배달비|배달팁|포장비|쿠폰|할인|서비스|수수료"
OPTION_WORDS = "추가|옵션|토핑|사리|변경|선택|곱빼기|맵기"
MAIN_FLOOR, MAIN_SHARE = 2000.0, 0.25


@by_heat
def main_item_segments(
    df: DataFrame, order: Sequence[str], is_main: Column, price, is_hall: Column | None, paid_dish: bool = False,
    line_order: Sequence | None = None, also: dict[str, Column] | None = None, hot=AUTO,
) -> DataFrame:
    """Menu name per line: every main item starts a segment that runs to the next one.

    Orders without a registered main item: hall orders take their dearest line,
    delivery orders get segments from lines that look like main dishes (price at
    least max(floor, share of the dearest), neither fee nor option). Without
    ``is_hall`` every such order takes its dearest line that is no fee
    (``paid_dish``: and not free). Orders without any named line stay null.

    ``line_order`` is what ``item_seq`` was counted by: rows sorted by it are not sorted again. ``also`` are
    whole-order values of later steps, attached in the same pass and left on the rows.
    """
    also = also or {}
    name = blank_to_null("item_name")
    fee = F.coalesce(F.col("item_name").rlike(FEE_WORDS), F.lit(False))
    option = F.coalesce(F.col("item_name").rlike(OPTION_WORDS), F.lit(False))
    rows = df.withColumns(
        {
            "_name": name, "_price": F.coalesce(col(price), F.lit(0)).cast("double"),
            "_main": F.coalesce(is_main, F.lit(False)) & name.isNotNull() & (F.coalesce(col(price), F.lit(0)) > 0),
            "_fee": fee, "_opt": option,
            "_hall": F.coalesce(is_hall, F.lit(False)) if is_hall is not None else F.lit(True),
        }
    )
    best = lambda cond: F.min(
        F.when(F.col("_name").isNotNull() & cond, F.struct((-F.col("_price")).alias("p"), F.col(SEQ).alias("s"), F.col("_name").alias("n")))
    )
    rows = attach(
        rows, order,
        {
            "_has_main": F.max("_main"),
            "_max": F.max(F.when(F.col("_name").isNotNull(), F.col("_price"))),
            "_is_hall": F.min_by("_hall", SEQ),
            "_best_dish": best(~F.col("_fee") & (F.col("_price") > 0) if paid_dish else ~F.col("_fee")),
            "_best_any": best(F.lit(True)),
            **also,
        },
        hot=hot,
    )
    looks_main = (
        (F.col("_price") >= F.greatest(F.lit(MAIN_FLOOR), F.col("_max") * MAIN_SHARE))
        & ~F.col("_fee") & ~F.col("_opt") & F.col("_name").isNotNull()
    )
    starts = F.when(F.col("_has_main"), F.col("_main")).otherwise(~F.col("_is_hall") & F.coalesce(looks_main, F.lit(False)))
    rows = rows.withColumn("_start", F.when(starts, F.col("_name")))
    if hot is None:  # both values of one sorted window
        w = Window.partitionBy(*order).orderBy(*(line_order or [SEQ]))
        upto, whole = (w.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, Window.unboundedFollowing))
        rows = rows.withColumns({"_seg": F.last("_start", True).over(upto), "_first": F.first("_start", True).over(whole)})
    else:
        rows = attach(rows, order, {"_first": F.min_by("_start", F.when(F.col("_start").isNotNull(), F.col(SEQ)))}, hot=hot)
        rows = running(rows, order, [SEQ], {"_seg": ("last", "_start")}, hot=hot)
    menu = F.coalesce("_seg", "_first", F.col("_best_dish.n"), F.col("_best_any.n"))
    return rows.withColumn("menu_name", menu).select(
        *[c for c in df.columns if c != "menu_name"], *also, "menu_name"
    )


def menu_group_segments(df: DataFrame, order: Sequence[str], price: str, hot=AUTO) -> DataFrame:
    """0-based group number; a priced line (and the first line) starts a new group."""
    start = F.when(col(price).isNotNull() | (F.col(SEQ) == 1), 1).otherwise(0)
    out = running(df, order, [SEQ], {"_g": ("sum", start)}, hot=hot)
    return out.withColumn("menu_group", F.col("_g") - 1).drop("_g")


def share_values(share: str) -> dict[str, Column]:
    return {"_total": F.sum(share)}


def proportional_allocation(
    df: DataFrame, order: Sequence[str], share: str, amount: str, out: str, attached: bool = False, hot=AUTO
) -> DataFrame:
    """Order amount split by each line's share of the order, rounded; 0 when the shares sum to 0."""
    rows = df if attached else attach(df, order, share_values(share), hot=hot)
    part = F.col(share).cast("double") / F.col("_total").cast("double") * F.col(amount)
    value = F.when(F.col("_total") == 0, 0).when(F.col("_total") == F.col(amount), F.col(share)).otherwise(rnd_int(part))
    return rows.withColumn(out, F.when(F.col("_total") == 0, 0).otherwise(value).cast("bigint")).drop("_total")


@by_heat
def remainder_allocation(
    df: DataFrame, order: Sequence[str], group: str, price: str, qty: str, option_price: str, amount: str, out: str,
    hot=AUTO,
) -> DataFrame:
    """Order amount split exactly: by group weight, then inside a group by paid options.

    The weight of a group is price x quantity of its main line (the first priced,
    else the first line). All groups but the last get their rounded share, the
    last takes the remainder. In a group with paid options these share the
    group's amount the same way; without, the main line takes it all.
    """
    gk = [*order, group]
    seq, gid = F.col(SEQ), F.col(group)
    rank = F.when(col(price).isNotNull(), 0).otherwise(1)
    rows = attach(df, gk, {"_m": F.min(F.struct(rank.alias("k"), seq.alias("s")))}, hot=hot)
    is_main = seq == F.col("_m.s")
    weight = F.coalesce(col(price), F.lit(0)).cast("double") * F.when(col(qty) > 0, col(qty)).otherwise(1)
    rows = rows.withColumn("_w", F.when(is_main, weight))
    rows = attach(rows, order, {"_tw": F.sum("_w"), "_last": F.max(group)}, hot=hot)
    # Group amounts live on the main lines first, so they sum up without a grouping of their own.
    share = F.when(F.col("_tw") > 0, rnd_int(col(amount) * F.col("_w") / F.col("_tw"))).otherwise(0)
    rows = rows.withColumn("_r", F.when(is_main & (gid != F.col("_last")), share))
    rows = attach(rows, order, {"_given": F.sum("_r")}, hot=hot)
    rest = col(amount) - F.coalesce("_given", F.lit(0))
    rows = rows.withColumn("_r", F.when(is_main & (gid == F.col("_last")), rest).otherwise(F.col("_r")))
    rows = rows.withColumn("_paid", F.when(~is_main & (col(option_price) > 0), col(option_price)))
    rows = attach(
        rows, gk,
        {"_ga": F.max("_r"), "_pt": F.sum("_paid"), "_lo": F.max(F.when(F.col("_paid").isNotNull(), seq))},
        hot=hot,
    )
    part = F.when(F.col("_paid").isNotNull() & (seq != F.col("_lo")), rnd_int(F.col("_ga") * F.col("_paid") / F.col("_pt")))
    rows = attach(rows.withColumn("_part", part), gk, {"_shared": F.sum("_part")}, hot=hot)
    value = (
        F.when(F.col("_part").isNotNull(), F.col("_part"))
        .when(seq == F.col("_lo"), F.col("_ga") - F.coalesce("_shared", F.lit(0)))
        .when(is_main & F.col("_lo").isNull(), F.col("_ga"))
        .otherwise(0)
    )
    return rows.withColumn(out, value.cast("bigint")).select(*df.columns, out)


def spread_values(value: str) -> dict[str, Column]:
    return {"_first": F.min_by(col(value), F.when(col(value) != 0, F.col(SEQ))), "_most": F.max(value)}


def first_nonzero_spread(df: DataFrame, order: Sequence[str], value: str, out: str, attached: bool = False, hot=AUTO) -> DataFrame:
    """Value given on one line of the order put on all lines: the first non-zero one, else the largest."""
    rows = df if attached else attach(df, order, spread_values(value), hot=hot)
    return rows.withColumn(out, F.coalesce("_first", "_most", F.lit(0))).drop("_first", "_most")


def time_values(time: str = "order_time") -> dict[str, Column]:
    t = blank_to_null(time)
    return {"_t": F.min_by(t, F.when(t.isNotNull(), F.col(SEQ)))}


def order_time_unify(df: DataFrame, order: Sequence[str], time: str = "order_time", attached: bool = False, hot=AUTO) -> DataFrame:
    """First non-empty time of the order on all its lines."""
    out = df if attached else attach(df, order, time_values(time), hot=hot)
    return out.withColumn(time, F.coalesce("_t", F.lit(""))).drop("_t")


# Id and name of a balancing line.
ADJUST_ID, ADJUST_NAME = "__ADJ__", "정산차액"


def balance_values(head_amount: str) -> dict[str, Column]:
    return {
        "_sum": F.sum("total_price"), "_seq": F.max(SEQ), "_head": F.min_by(head_amount, SEQ),
        "_rep": F.max(F.struct(F.abs("total_price").alias("a"), (-F.col(SEQ)).alias("s"))),
    }


def adjustment_rows(df: DataFrame, order: Sequence[str], head_amount: str, attached: bool = False, hot=AUTO) -> DataFrame:
    """One balancing line per receipt whose header amount differs from the sum of its lines.

    It copies the attributes of the line with the largest absolute amount, and
    comes out of that line itself, so the lines are gone through once.
    """
    values = balance_values(head_amount)
    rows = df if attached else attach(df, order, values, hot=hot)
    diff = F.col("_head") - F.col("_sum")
    new = {
        SEQ: F.col("_seq") + 1, "item_id": F.lit(ADJUST_ID), "item_name": F.lit(ADJUST_NAME), "qty": F.lit(1),
        "unit_price": F.abs(diff), "total_price": diff, "discount_amount": F.lit(0),
        "sale_type": F.when(diff >= 0, "정상").otherwise("취소"), "order_cnt": F.lit(0),
    }
    twice = (F.col(SEQ) == -F.col("_rep.s")) & (diff != 0)
    copies = rows.withColumn("_new", F.explode(F.when(twice, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    given = [f for f in df.schema.fields if f.name not in values]
    return copies.select(
        *[F.when(F.col("_new"), new[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in new else F.col(f.name) for f in given]
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], stamps: Sequence, tie: Sequence = ()) -> DataFrame:
    """Newest row per key; missing stamps count as oldest."""
    return keep_one(df, keys, [*[col(s).desc_nulls_last() for s in stamps], *tie])


def is_latest_flag(df: DataFrame, keys: Sequence[str], stamp: str, version: str) -> DataFrame:
    """Y on the newest version per key, N on all others (``version`` breaks ties)."""
    newest = df.groupBy(*keys).agg(F.max(F.struct(stamp, version)).alias("_top"))
    out = df.join(newest, list(keys))
    hit = F.struct(F.col(stamp), F.col(version)).eqNullSafe(F.col("_top"))
    return out.withColumn("is_latest", F.when(hit, "Y").otherwise("N")).drop("_top")


def canonical_keys(df: DataFrame, columns: dict[str, bool]) -> list[Column]:
    """What two lines share if they have the same canonical form: whole numbers as they are, other numbers as decimals, text trimmed."""
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    number = lambda c: F.bround(col(c).cast("decimal(30,8)"), 6)
    return [F.col(c) if c in whole else number(c) if numeric else text(c) for c, numeric in columns.items()]


def canonical_line_dedup(df: DataFrame, columns: dict[str, bool], newest_first: Sequence, within: Sequence[str] = ()) -> DataFrame:
    """One line per canonical form of the columns (name -> is numeric), the newest collected one.

    The values themselves are the key: a digest would be wider than most of them and does not compress in the shuffle.
    ``within`` are columns by which the rows lie together already and which follow from the canonical form.
    """
    return keep_one(df, [*within, *canonical_keys(df, columns)], newest_first)


def receipt_dedup(df: DataFrame, candidates: Sequence[str], newest_first: Sequence, least: int = 4) -> DataFrame:
    """One header per receipt by the stable key columns that exist; fewer than ``least`` leave the rows alone."""
    keys = [c for c in candidates if c in df.columns]
    return keep_one(df, keys, newest_first) if len(keys) >= least else df


def with_pk(df: DataFrame) -> DataFrame:
    return df.withColumn("_pk", unified_pk())
