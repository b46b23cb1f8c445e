"""Business rules as column expressions: types, revenue, signs, grades, diagnoses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.clean import text
from tillbook.functions.numbers import ratio
from tillbook.operators.core import AUTO, attach, col

# The order types of the unified fact, hall words and the cancel mark.
HALL_TABLE, HALL_PACK, DELIVERY_PACK, DELIVERY = "홀_테이블", "홀_포장", "배달_포장", "배달"
HALL, PACK = "홀", "포장"
CANCELLED, NORMAL = "취소", "정상"


def order_type_classify(
    platform, order_type, table, counter: Sequence[str], phone: str
) -> tuple[Column, Column]:
    """(platform, order type): counter channels by table name, phone and delivery pick-ups, the rest hall table."""
    p, o, t = text(platform), text(order_type), text(table)
    at_counter = p.isin(list(counter))
    pack, number, deliver = t.contains(PACK), t.rlike(r"^\d+$"), t.contains(DELIVERY)
    hall = at_counter & (pack | number)
    o1 = (
        F.when(at_counter & pack, HALL_PACK).when(at_counter & number, HALL_TABLE)
        .when(at_counter & deliver, DELIVERY).otherwise(o)
    )
    p1 = F.when(hall, HALL).otherwise(p)
    in_house = p1.isin([*counter, HALL])
    o2 = F.when((p1 == phone) & (o1 == PACK), HALL_PACK).when(~in_house & (o1 == PACK), DELIVERY_PACK).otherwise(o1)
    o3 = F.when(o2.isin(HALL_TABLE, HALL_PACK, DELIVERY_PACK, DELIVERY), o2).otherwise(HALL_TABLE)
    return p1, o3


def reclassify_by_order(df: DataFrame, order: str, mark: Column, values: dict[str, Column], hot=AUTO) -> DataFrame:
    """Set columns on every line of an order in which any line carries the mark."""
    out = attach(df, [order], {"_hit": F.max(F.coalesce(mark, F.lit(False)))}, hot=hot)
    return out.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in values.items()}).drop("_hit")


def mapped(c, table: dict[str, str]) -> Column:
    """Value by a small literal table, unknown values unchanged."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), text(c)), text(c))


# Fixed value: flat packaging charge of pick-up orders.
PACK_CHARGE = 2000


def platform_revenue(
    path, order_type, total, fee, discount, paid, address,
    flat_pack: Sequence[str], paid_less_fee: Sequence[str], total_less_fee: Sequence[str],
    own_rider: Sequence[str], rider_mark: str,
) -> Column:
    """Net revenue of an order by platform, never below 0.

    flat_pack: pick-ups lose the flat packaging charge, else the total counts.
    paid_less_fee: paid amount less delivery fee. total_less_fee: total less fee,
    0 when fully discounted. own_rider: total, less the fee when the address
    carries the rider mark. All other platforms count the paid amount.
    """
    p = text(path)
    pack, marked = text(order_type).contains(PACK), text(address).contains(rider_mark)
    total, fee, paid = col(total), col(fee), col(paid)
    less_fee = F.when(fee > 0, total - fee).otherwise(total)
    revenue = (
        F.when(p.isin(list(own_rider)), F.when(marked, less_fee).otherwise(total))
        .when(p.isin(list(total_less_fee)), F.when(total == col(discount), 0).otherwise(less_fee))
        .when(p.isin(list(paid_less_fee)), paid - fee)
        .when(p.isin(list(flat_pack)), F.when(pack, total - PACK_CHARGE).otherwise(total))
        .otherwise(paid)
    )
    return F.greatest(revenue, F.lit(0)).cast("bigint")


def signed_amount(amount, cancelled: Column) -> Column:
    """Cancelled lines negative, all others positive."""
    return F.when(cancelled, -F.abs(col(amount))).otherwise(F.abs(col(amount)))


def achievement_grade(rate) -> Column:
    r = col(rate)
    return F.when(r >= 100, "A").when(r >= 97, "B").when(r >= 93, "C").otherwise("D")


# Diagnosis labels.
DIAGNOSES = {
    "over": "목표초과", "near": "목표근접", "both": "유입과 구매단가 복합 문제", "price": "객단가/메뉴구성 문제",
    "pack": "포장유입 부족", "tables": "테이블수 부족",
}


def sales_diagnosis(grade, target_price, actual_price, tables, pack_share) -> Column:
    """Why a store missed its target: ticket size, visits or packaging."""
    d = DIAGNOSES
    price_ratio = F.when(col(target_price) > 0, ratio(actual_price, target_price)).otherwise(1.0)
    low_price = price_ratio < 0.9
    return (
        F.when(col(grade) == "A", d["over"]).when(col(grade) == "B", d["near"])
        .when(low_price & (F.coalesce(col(tables), F.lit(0)) < 20), d["both"])
        .when(low_price, d["price"])
        .when(F.coalesce(col(pack_share), F.lit(0.0)) < 8, d["pack"])
        .otherwise(d["tables"])
    )


def suggestions(rules: Sequence[tuple[str, Column]]) -> Column:
    """Codes of all rules that hold, in priority order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), code) for code, cond in rules]))


#: The limits of the four-area diagnosis, in percent where not said otherwise.
AREA_LIMITS = {
    "fall": -15, "order_fall": -15, "ticket_move": 10, "trend": -10, "fee_spike": 5, "fee_gap": 10, "fee_share": 33,
    "conversion": 5, "weak": -10, "ad_room": 7, "cook_long": 25, "cook": 20, "accept": 0.95, "promise": 0.9, "reorder": 0.12, "rating": 4.3,
}


def four_areas(limits: dict[str, float] | None = None, columns: Sequence[str] = ()) -> list[tuple[str, Column]]:
    """(code, condition) of the sales, fee, advertising and service diagnosis, in the order in which they are reported.

    Column names are those of the daily scorecard; ``columns`` names those at hand, others count as unknown, and an
    unknown figure meets no condition. A bad status is the third or fourth of the four. Pass the list to ``suggestions``.
    """
    at = AREA_LIMITS | (limits or {})
    v = lambda name: (F.col(name) if not columns or name in columns else F.lit(None)).cast("double")
    known = lambda cond: F.coalesce(cond, F.lit(False))
    bad = lambda name: known(F.col(name).isin("주의", "위험")) if not columns or name in columns else F.lit(False)
    change = lambda now, base: F.when(base > 0, (now / base - 1) * 100)
    fee_bad, ad_a_bad, ad_b_bad = bad("fee_status"), bad("ad_a_status"), bad("ad_b_status")
    ads_bad = ad_a_bad | ad_b_bad
    day, week = v("day_pct"), v("week_pct")
    together = known((day < at["fall"]) & (week < at["fall"]))
    measured = known((v("prev_orders") > 0) & (v("orders") > 0))
    fewer = measured & known(change(v("orders"), v("prev_orders")) < at["order_fall"])
    prev_ticket = v("prev_amount") / F.nullif(v("prev_orders"), F.lit(0.0))
    ticket = measured & ~fewer & known(F.abs(F.coalesce(change(v("ticket"), prev_ticket), F.lit(0.0))) > at["ticket_move"])
    fee, fee_a, fee_b = v("fee_rate"), v("fee_rate_a"), v("fee_rate_b")
    spike = known((fee > 0) & (v("prev_fee_rate") > 0) & (fee - v("prev_fee_rate") > at["fee_spike"]))
    gap = known((fee_a > 0) & (fee_b > 0) & (F.abs(fee_a - fee_b) > at["fee_gap"]))
    rate = lambda orders, clicks: F.when((v(clicks) > 0) & (v(orders) > 0), v(orders) / v(clicks) * 100)
    conv_a, conv_b = rate("ad_a_orders", "ad_a_clicks"), rate("ad_b_orders", "ad_b_clicks")
    room = known((v("ad_spend") > 0) & (v("amount") > 0) & (v("ad_spend") / F.nullif(v("amount"), F.lit(0.0)) * 100 < at["ad_room"]))
    below = lambda name, limit: (v(name) > 0) & (v(name) < at[limit])
    return [
        ("sales_orders_invest", together & fewer & ~fee_bad & ~ads_bad),
        ("sales_orders_fee", together & fewer & fee_bad),
        ("sales_orders_campaign", together & fewer & ~fee_bad & ads_bad),
        ("sales_ticket", together & ticket),
        ("sales_together", together & ~fewer & ~ticket),
        ("sales_one_day", (day < at["fall"]) & (week >= 0)),
        ("sales_trend", (v("ma14") > 0) & (change(v("ma14"), v("ma28")) < at["trend"])),
        ("fee_spike", fee_bad & spike),
        ("fee_platform", fee_bad & ~spike & gap),
        ("fee_high", fee_bad & ~spike & ~gap),
        ("fee_third", ~fee_bad & (fee > at["fee_share"])),
        ("ad_b_conversion", ad_b_bad & (conv_b < at["conversion"])),
        ("ad_b_targeting", ad_b_bad & (conv_b >= at["conversion"])),
        ("ad_b_review", ad_b_bad & conv_b.isNull()),
        ("ad_a_conversion", ad_a_bad & conv_a.isNotNull()),
        ("ad_a_review", ad_a_bad & conv_a.isNull()),
        ("ad_room", ~ads_bad & ~fee_bad & (known(day < at["weak"]) | known(week < at["weak"])) & room),
        ("cook_very_slow", v("cook_minutes") > at["cook_long"]),
        ("cook_slow", (v("cook_minutes") > at["cook"]) & (v("cook_minutes") <= at["cook_long"])),
        ("accept_low", below("accept_rate", "accept")),
        ("promise_low", below("promise_rate", "promise")),
        ("reorder_low", below("reorder_rate", "reorder")),
        ("rating_low", below("rating", "rating")),
        ("service_bad", bad("service_status")),
    ]


def prioritize(codes) -> dict[str, Column]:
    """First suggestion, second one, and the rest as watch list."""
    c = col(codes)
    return {
        "primary_code": F.get(c, F.lit(0)), "secondary_code": F.get(c, F.lit(1)),
        "watch_codes": F.array_join(F.slice(c, F.lit(3), F.greatest(F.size(c), F.lit(1))), ","),
    }


def scorecard_findings(scores: Sequence[tuple[str, str, str]]) -> Column:
    """The two worst views of a scorecard (score desc, then the deeper fall) as 'name pct' text."""
    items = F.array(
        *[
            F.when(
                (F.col(s) > 0) & F.col(p).isNotNull(),
                F.struct((-F.col(s)).alias("s"), F.col(p).alias("p"), F.lit(n).alias("n")),
            )
            for n, s, p in scores
        ]
    )
    worst = F.slice(F.array_sort(F.array_compact(items)), 1, 2)
    return F.array_join(F.transform(worst, lambda x: F.concat_ws(" ", x["n"], F.format_number(x["p"], 1))), ", ")


def scorecard_cause(short, mid, long, yoy) -> Column:
    """Cause code from the combination of scores above 0."""
    s, m, l, y = (col(c) > 0 for c in (short, mid, long, yoy))
    return (
        F.when(s & m & l & y, "broad_weakness").when(s & m, "sudden_and_mid").when(m & l, "slowing_month")
        .when(l & y, "month_and_year").when(s, "one_day").when(m, "two_weeks").when(l, "month").when(y, "year")
        .otherwise("none")
    )


def drop_total_rows(df: DataFrame, columns: Sequence[str], label: str = "합계") -> DataFrame:
    """Rows in which none of the columns carries the total label."""
    has = F.exists(F.array(*[text(c) for c in columns]), lambda x: x == label)
    return df.where(~has)


def any_status(columns: Sequence[str], values: Sequence[str]) -> Column:
    return F.exists(F.array(*[text(c) for c in columns]), lambda x: x.isin(list(values)))


#: The labels an item can have, and those whose parent menu must be known.
ITEM_LABELS = ("메인", "1인", "사이드", "기타", "주류", "음료", "토핑", "옵션", "세트")
PARENT_LABELS = ("메인", "1인")


def review_reasons(name, label, menu_count, reviewed=None, labelled_by=None) -> Column:
    """Why an item still needs a look: names, label, several parent menus, else a label by a model; blank once reviewed."""
    n, lab = text(name), text(label)
    unknown, rest = ~lab.isin(*ITEM_LABELS), lab == "기타"
    many = (F.coalesce(col(menu_count), F.lit(0)) > 1) & lab.isin(*PARENT_LABELS)
    model = (text(labelled_by) if labelled_by is not None else F.lit("")) == "llm"
    found = F.array_compact(
        F.array(
            F.when(n == "", "표준명 미입력"), F.when(unknown, "수동분류 미입력"), F.when(rest, "기타 분류 확인"), F.when(many, "부모메뉴 후보 다수"),
            F.when(model & (n != "") & ~unknown & ~rest & ~many, "LLM 분류 확인"),
        )
    )
    done = F.upper(text(reviewed)) == "Y" if reviewed is not None else F.lit(False)
    return F.when(done, "").otherwise(F.array_join(found, ", "))
