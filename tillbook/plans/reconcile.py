"""Cross-source reconciliation, coverage and quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.clean import clean_item_name, holiday_dates, regular_holiday_weekdays, suspension_minutes, text
from tillbook.functions.numbers import ratio, rnd
from tillbook.operators.core import col, keep_one
from tillbook.operators.joins import full_outer_reconcile

ZERO = F.lit


def order_max_then_sum(lines: DataFrame, order: str, keys: Sequence[str], amount: str, out: str = "amount") -> DataFrame:
    """Amounts repeat on the lines of an order: the order's maximum first, then the sum per key."""
    per_order = lines.groupBy(*keys, order).agg(F.max(amount).alias("_a"))
    return per_order.groupBy(*keys).agg(F.sum("_a").alias(out))


# Statuses of the collection comparison.
MISSING, GAP, FINE, NOT_COMPARED, LOW, HIGH = "누락", "차이", "정상", "비교대상아님", "차이_낮음", "차이_높음"


def collection_compare(long: DataFrame, sources: Sequence[str], expected: dict[str, Sequence[str]], limit: float = 2.0) -> DataFrame:
    """Sources side by side per (day, store, platform group) with gaps, statuses and missing lists.

    ``sources`` are in baseline order; ``expected`` names those a group should have.
    """
    keys = ["sale_date", "store", "platform_group"]
    wide = long.groupBy(*keys).pivot("source", list(sources)).agg(F.sum("amount"))
    wide = wide.withColumns(
        {f"present_{s}": F.col(s).isNotNull().cast("int") for s in sources}
        | {f"amt_{s}": F.coalesce(F.col(s), F.lit(0)).cast("bigint") for s in sources}
    ).drop(*sources)
    want = lambda s: F.col("platform_group").isin([g for g, ss in expected.items() if s in ss])
    amounts = F.array_compact(F.array(*[F.when(want(s), F.col(f"amt_{s}")) for s in sources]))
    have = lambda s: want(s) & (F.col(f"present_{s}") == 1)
    lack = lambda s: want(s) & (F.col(f"present_{s}") == 0)
    names = lambda test: F.array_compact(F.array(*[F.when(test(s), s) for s in sources]))
    first = F.coalesce(*[F.when(have(s), s) for s in sources])
    base = F.coalesce(*[F.when(have(s), F.col(f"amt_{s}")) for s in sources], F.lit(0))
    wide = wide.withColumns(
        {
            "n_present": F.size(names(have)), "n_expected": F.size(names(want)),
            "baseline_source": F.coalesce(first, F.lit("")), "baseline_amt": base.cast("bigint"),
            "amt_max": F.coalesce(F.array_max(amounts), F.lit(0)), "amt_min": F.coalesce(F.array_min(amounts), F.lit(0)),
            "missing_sources": F.array_join(names(lack), ","),
        }
    )
    wide = wide.withColumn("gap", F.col("amt_max") - F.col("amt_min"))
    wide = wide.withColumn("gap_rate", F.coalesce(rnd(ratio("gap", "amt_max") * 100, 2), F.lit(0.0)))
    wide_gap = F.col("gap_rate") >= limit
    issue = lambda s: (
        F.when(~want(s), NOT_COMPARED).when(lack(s), MISSING)
        .when(wide_gap & (F.col(f"amt_{s}") < F.col("amt_max")), LOW)
        .when(wide_gap & (F.col(f"amt_{s}") > F.col("amt_min")), HIGH).otherwise(FINE)
    )
    wide = wide.withColumn(
        "status", F.when(F.col("missing_sources") != "", MISSING).when(wide_gap, GAP).otherwise(FINE)
    ).withColumns({f"issue_{s}": issue(s) for s in sources})
    notes = [F.when(~F.col(f"issue_{s}").isin(FINE, NOT_COMPARED), F.concat_ws(" ", F.lit(s), f"issue_{s}")) for s in sources]
    return wide.withColumn("issue_summary", F.array_join(F.array_compact(F.array(*notes)), ","))


def order_vs_item_totals(heads: DataFrame, items: DataFrame, no_data: DataFrame, tolerance: int = 0) -> DataFrame:
    """Header sum against line sum per (day, store); empty sides and gaps above the tolerance only."""
    keys = ["sale_date", "store"]
    a = heads.groupBy(*keys).agg(F.sum("amount").alias("order_sum"))
    b = items.groupBy(*keys).agg(F.sum("amount").alias("item_sum"))
    both = a.join(b, keys, "full").join(no_data.select(*keys).distinct(), keys, "left_anti")
    issue = (
        F.when(F.col("order_sum").isNull() | F.col("item_sum").isNull(), "empty_side")
        .when(F.abs(F.col("order_sum") - F.col("item_sum")) > tolerance, "mismatch")
    )
    return both.withColumn("issue", issue).where(F.col("issue").isNotNull())


def daily_from_orders(orders: DataFrame) -> DataFrame:
    """Daily row (gross, discount, net, receipts) derived from the orders, all-zero days dropped."""
    g = orders.groupBy("sale_date", "ym", "store").agg(
        F.sum("gross").alias("gross"), F.sum("discount").alias("discount"), F.sum("net").alias("net"),
        F.count(F.lit(1)).alias("receipts"),
    )
    g = g.where((F.col("gross") != 0) | (F.col("discount") != 0) | (F.col("net") != 0) | (F.col("receipts") != 0))
    return g.withColumn("_pk", F.md5(F.concat_ws("|", "sale_date", "store", F.lit("daily"))))


def check_against_daily(derived: DataFrame, reported: DataFrame) -> DataFrame:
    """Derived and reported daily rows side by side; ok when net and receipts agree."""
    keys = ["sale_date", "store"]
    r = reported.select(*keys, F.col("net").alias("reported_net"), F.col("receipts").alias("reported_receipts"))
    ok = F.coalesce((F.col("net") == F.col("reported_net")) & (F.col("receipts") == F.col("reported_receipts")), F.lit(False))
    return derived.drop("ym", "_pk").join(r, keys, "full").withColumn("ok", ok.cast("int"))


def platform_vs_report(orders: DataFrame, report: DataFrame, cancelled_minus: bool = False) -> DataFrame:
    """Delivered orders (once each) against the platform report per store.

    A report of 0 with own orders is a gap of the report's account link; stores
    of one side only are compared with 0; both 0 means no delivery that day.
    """
    if cancelled_minus:
        a = orders.groupBy("sale_date", "store").agg(
            F.sum(F.when(F.col("cancelled"), -F.col("amount")).otherwise(F.col("amount"))).alias("_own")
        )
    else:
        delivered = orders.where(~F.col("cancelled"))
        a = order_max_then_sum(delivered, "order_id", ["sale_date", "store"], "amount", "_own")
    zero = F.lit(0).cast("bigint")
    j = report.join(a, ["sale_date", "store"], "full").select(
        "sale_date", "store", F.coalesce("reported", zero).alias("reported"), F.coalesce("_own", zero).alias("own")
    )
    kind = (
        F.when((F.col("reported") == 0) & (F.col("own") == 0), "no_delivery")
        .when((F.col("reported") == 0) & (F.col("own") > 0), "report_gap")
        .when(F.col("reported") == F.col("own"), "matched").otherwise("mismatch")
    )
    return j.withColumn("kind", kind)


def brand_coverage(expected: DataFrame, rows: DataFrame, day_rows: DataFrame) -> DataFrame:
    """Expected, present and active brands per store: missing partitions and stale ones."""
    sets = lambda df, name: df.select("store", "brand").distinct().groupBy("store").agg(F.array_sort(F.collect_set("brand")).alias(name))
    empty = F.array().cast("array<string>")
    j = (
        sets(expected, "_e").join(sets(rows, "_x"), "store", "left").join(sets(day_rows, "_a"), "store", "left")
        .withColumns({c: F.coalesce(c, empty) for c in ("_x", "_a")})
    )
    missing = F.array_except("_e", "_x")
    stale = F.array_except(F.array_intersect("_e", "_x"), F.col("_a"))
    return j.select(
        "store", F.array_join("_e", ",").alias("expected_brands"), F.array_join("_a", ",").alias("active_brands"),
        F.array_join(missing, ",").alias("missing_brands"), F.array_join(stale, ",").alias("stale_brands"),
        F.when(F.size(missing) > 0, "missing_partition").when(F.size(stale) > 0, "stale_partition").alias("issue_type"),
    )


def count_amount_check(rows: DataFrame, expected: DataFrame, keys: Sequence[str], order: str, amounts: Sequence[str]) -> DataFrame:
    """Order count and any one of the amount sums equal the platform's own summary.

    Rows without an order id (options unfolded below an order) do not count as orders. Null when there is no summary; a
    summary without rows is compared with zeros. The first matching amount column is named.
    """
    known = F.nullif(F.trim(F.col(order).cast("string")), F.lit(""))
    g = rows.groupBy(*keys).agg(F.countDistinct(known).alias("actual_count"), *[F.sum(a).alias(f"sum_{a}") for a in amounts])
    j = g.join(expected, list(keys), "full")
    j = j.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("actual_count", *(f"sum_{a}" for a in amounts))})
    hit = F.coalesce(*[F.when(F.col(f"sum_{a}") == F.col("expected_amount"), a) for a in amounts])
    matched = (F.col("actual_count") == F.col("expected_count")) & hit.isNotNull()
    return j.select(
        *keys, "actual_count", "expected_count", "expected_amount",
        F.coalesce(hit, F.lit(amounts[0])).alias("amount_source"),
        F.when(F.col("expected_count").isNotNull(), F.coalesce(matched, F.lit(False)).cast("int")).alias("matched"),
    )


def snapshot_shrink_check(new: DataFrame, prev: DataFrame, day: str, tolerance: float = 0.05) -> DataFrame:
    """Days whose row count fell by more than the tolerance against the previous snapshot."""
    a = new.groupBy(day).agg(F.count(F.lit(1)).alias("new_count"))
    b = prev.groupBy(day).agg(F.count(F.lit(1)).alias("prev_count"))
    return a.join(b, day).where(F.col("new_count") < F.col("prev_count") * (1 - tolerance))


def monthly_amount_integrity(heads: DataFrame, items: DataFrame, as_of) -> DataFrame:
    """Header sum against item sum per completed month and store."""
    before = F.col("ym") < F.date_format(F.lit(as_of).cast("date"), "yyyy-MM")
    a = heads.where(before).groupBy("ym", "store").agg(F.sum("amount").alias("reported"))
    b = items.where(before).groupBy("ym", "store").agg(F.sum("amount").alias("unified"))
    return full_outer_reconcile(a, b, ["ym", "store"], "reported", "unified")


def mart_quality_checks(df: DataFrame, unique: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """(check, bad_rows, ok) of a uniqueness rule and row rules, each rule true on a bad row."""
    rows = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    dup = df.groupBy(*unique).agg((F.count(F.lit(1)) - 1).alias("_d")).agg(F.coalesce(F.sum("_d"), F.lit(0)).alias("bad_rows"))
    long = rows.unpivot([], list(rules), "check", "bad_rows")
    return dup.select(F.lit("duplicate_key").alias("check"), "bad_rows").unionByName(long).withColumn(
        "ok", (F.col("bad_rows") == 0).cast("int")
    )


def join_retention(left: DataFrame, joined: DataFrame) -> DataFrame:
    """Row counts before and after a left join that must keep them."""
    a = left.agg(F.count(F.lit(1)).alias("n")).select(F.lit("before").alias("side"), "n")
    b = joined.agg(F.count(F.lit(1)).alias("n")).select(F.lit("after").alias("side"), "n")
    both = a.unionByName(b).groupBy().pivot("side", ["before", "after"]).agg(F.max("n"))
    return both.withColumn("kept", (F.col("before") == F.col("after")).cast("int"))


def run_health(runs: DataFrame, tasks: DataFrame, short_seconds: float = 10.0) -> DataFrame:
    """Latest run per job with task counts and its OK / WARN / FAIL verdict."""
    last = keep_one(runs, ["job"], [F.col("run_at").desc(), F.col("run_id").desc()])
    n = lambda s: F.count(F.when(F.col("state") == s, 1))
    counts = tasks.groupBy("job", "run_id").agg(
        F.count(F.lit(1)).alias("total"), n("success").alias("success"), n("failed").alias("failed"),
        n("skipped").alias("skipped"), n("upstream_failed").alias("upstream_failed"),
    )
    j = last.join(counts, ["job", "run_id"], "left").fillna(0, ["total", "success", "failed", "skipped", "upstream_failed"])
    c = F.col
    planned = (
        (c("skipped") > 0) & (c("failed") == 0) & (c("upstream_failed") == 0) & (c("run_state") == "success")
        & (c("success") + c("skipped") == c("total"))
    )
    kind = (
        F.when(c("run_state") == "failed", "run_failed")
        .when((c("total") > 0) & (c("skipped") * 2 >= c("total")) & ~planned, "high_skip_ratio")
        .when(c("upstream_failed") > 0, "upstream_failed")
        .when((c("total") > 0) & (c("skipped") == c("total")), "all_skipped")
        .when(~planned & (c("seconds") > 0) & (c("seconds") < short_seconds), "short_duration")
    )
    fails = ("run_failed", "high_skip_ratio", "upstream_failed")
    return j.withColumn("fail_type", kind).withColumn(
        "verdict", F.when(c("fail_type").isin(*fails), "FAIL").when(c("fail_type").isNotNull(), "WARN").otherwise("OK")
    )


def unresolved_failures(runs: DataFrame, day) -> DataFrame:
    """Jobs whose last run of the day failed; a later good run of the same day resolves a failure."""
    of_day = runs.where(F.to_date("run_at") == F.lit(day).cast("date"))
    last = keep_one(of_day, ["job"], [F.col("run_at").desc(), F.col("run_id").desc()])
    return last.where(F.col("run_state").isin("failed", "upstream_failed"))


def source_collisions(df: DataFrame, column: str = "source") -> DataFrame:
    """Normalised source names with their spellings: blank ones, and names that differ by case or spaces only."""
    spell = df.groupBy(F.coalesce(column, F.lit("")).alias("_raw")).agg(F.count(F.lit(1)).alias("_n"))
    g = spell.groupBy(F.lower(F.trim("_raw")).alias("name")).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("spellings"),
        F.array_join(F.array_sort(F.collect_set("_raw")), "|").alias("variants"),
    )
    issue = F.when(F.col("name") == "", "blank").when(F.col("spellings") > 1, "collision")
    return g.withColumn("issue", issue).where(F.col("issue").isNotNull())


def start_hours(runs: DataFrame) -> DataFrame:
    """Number of runs per start hour."""
    return runs.groupBy(F.hour("run_at").alias("hour")).agg(F.count(F.lit(1)).alias("runs"))


NONE_WORD = "없음"


def monthly_operation(changes: DataFrame, hours: DataFrame, first, last) -> DataFrame:
    """Operating days and hours per store and month from change events.

    ``changes``: store, event_id, ts, kind (holiday / pause), regular_after,
    temp_before, temp_after, pause_store, pause_app. ``hours``: store, weekday,
    hours. A month without events is a normal one; the running month ends at
    ``last``.
    """
    said = lambda c: (text(c) != "") & (text(c) != NONE_WORD)
    lo, hi = F.trunc(F.lit(first).cast("date"), "MM"), F.lit(last).cast("date")
    months = hours.select("store").distinct().select("store", F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("m"))

    # Regular weekdays: the newest setting of each month, carried on to later months.
    hol = changes.where(F.col("kind") == "holiday")
    reg = hol.where(said("regular_after")).groupBy("store", F.trunc("ts", "MM").alias("m")).agg(
        F.max_by("regular_after", F.struct("ts", "event_id")).alias("_r")
    )
    w = Window.partitionBy("store").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    state = months.join(reg, ["store", "m"], "full").withColumn("_r", F.last("_r", ignorenulls=True).over(w))
    state = state.where(F.col("m").between(lo, hi)).withColumn(
        "_off", F.coalesce(regular_holiday_weekdays("_r"), F.array().cast("array<int>"))
    )

    # Temporary holidays: per date the last event decides; a cancel does not reach back before its own day.
    sets = hol.where(said("temp_after")).select(
        "store", F.explode(holiday_dates("temp_after")).alias("day"), F.struct("ts", "event_id", F.lit(0).alias("o")).alias("_at"), F.lit(1).alias("_on")
    )
    cancels = hol.where(said("temp_before")).select(
        "store", F.explode(holiday_dates("temp_before")).alias("day"), F.struct("ts", "event_id", F.lit(1).alias("o")).alias("_at"), F.lit(0).alias("_on")
    ).where(F.col("day") >= F.col("_at.ts").cast("date"))
    temp = sets.unionByName(cancels).groupBy("store", "day").agg(F.max_by("_on", "_at").alias("_temp"))

    days = state.select(
        "store", "m", "_off", F.explode(F.sequence(F.col("m").cast("date"), F.least(F.last_day("m"), hi))).alias("day")
    ).withColumn("weekday", F.weekday("day"))
    days = days.join(temp, ["store", "day"], "left").join(hours, ["store", "weekday"], "left")
    regular = F.array_contains("_off", F.col("weekday"))
    closed_temp = ~regular & (F.coalesce("_temp", F.lit(0)) == 1)
    open_day = ~regular & ~closed_temp
    money = lambda c: F.coalesce(c.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    base = days.groupBy("store", "m").agg(
        F.count_if(open_day).alias("operating_days"), F.count_if(regular).alias("regular_off"),
        F.count_if(closed_temp).alias("temp_off"), F.sum(money(F.when(open_day, F.col("hours")))).alias("base_hours"),
    )

    # Pauses: the platform logs one event on several rows.
    pause = changes.where(F.col("kind") == "pause").select(
        "store", "ts", F.when(said("pause_store"), text("pause_store")).alias("_s"),
        F.when(~said("pause_store") & said("pause_app"), text("pause_app")).alias("_p"),
    ).distinct()
    hrs = lambda c: F.bround((suspension_minutes(c) / F.lit(60.0)).cast("decimal(18,8)"), 2).cast("decimal(18,2)")
    pause = pause.select("store", F.trunc("ts", "MM").alias("m"), hrs("_s").alias("_sh"), hrs("_p").alias("_ph"), "_s", "_p")
    pause = pause.groupBy("store", "m").agg(
        F.count_if(F.col("_s").isNotNull() & (F.col("_sh") > 0)).alias("pause_count"), F.sum(F.when(F.col("_s").isNotNull(), F.col("_sh"))).alias("pause_hours"),
        F.count_if(F.col("_p").isNotNull() & (F.col("_ph") > 0)).alias("app_pause_count"), F.sum(F.when(F.col("_p").isNotNull(), F.col("_ph"))).alias("app_pause_hours"),
    )
    out = base.join(pause, ["store", "m"], "left").fillna(0, ["pause_count", "app_pause_count"])
    zero = F.lit(0).cast("decimal(18,2)")
    store_h = F.greatest(zero, F.col("base_hours") - money(F.col("pause_hours")))
    out = out.withColumn("store_hours", store_h)
    return out.select(
        "store", F.date_format("m", "yyyy-MM").alias("ym"), "operating_days", "regular_off", "temp_off",
        F.coalesce(rnd(ratio("base_hours", "operating_days"), 2), F.lit(0.0)).alias("avg_daily_hours"),
        "pause_count", money(F.col("pause_hours")).cast("double").alias("pause_hours"),
        "app_pause_count", money(F.col("app_pause_hours")).cast("double").alias("app_pause_hours"),
        F.col("store_hours").cast("double").alias("store_hours"),
        F.greatest(zero, F.col("store_hours") - money(F.col("app_pause_hours"))).cast("double").alias("app_hours"),
    )


#: Menu names that are charges and services, no dishes.
FEE_MENUS = "배달비|배달팁|포장비|쿠폰|할인|서비스|수수료"


def order_structure(lines: DataFrame, types: dict[str, str], keyword: str) -> DataFrame:
    """One row per order: main menu, first options and lists by item type, final menu name.

    ``types`` maps main / size / protein / flavor / topping / side / drink to the item type labels. Without a main item
    the dearest line counts, lines marked ``exclude_check`` only if there are no others. The order is a hall order by its
    first line; the menus of others make up the final name, cleaned, each once, charges left out. Lines are first
    reduced to one row per order, type and name with their places, so the lists gather names, not lines.
    """
    keys = ["order_id", "sale_date", "store", "platform"]
    excluded = F.upper(text("exclude_check")) == "Y" if "exclude_check" in lines.columns else F.lit(False)
    name, seq, kind = F.col("item_name"), F.col("item_seq"), F.col("item_type")
    first = lambda t: F.coalesce(F.min_by(name, F.when(kind == types[t], seq)), F.lit(""))
    dear = F.min_by(name, F.struct(excluded.alias("x"), (-F.col("unit_price")).alias("p"), seq.alias("s")))
    g = lines.groupBy(*keys).agg(
        F.coalesce(F.min_by(name, F.when(kind == types["main"], seq)), F.min_by(name, F.when(name.contains(keyword), seq)), dear).alias("main_menu"),
        first("size").alias("size_option"), first("protein").alias("protein_option"), first("flavor").alias("flavor_option"),
        F.min_by(F.coalesce(F.col("order_type"), F.lit("")), seq).contains("홀").alias("_hall"),
    )

    joined = lambda places, sep: F.array_join(F.transform(F.array_sort(places), lambda x: x["n"]), sep)
    part = {t: types[t] for t in ("topping", "side", "drink")}
    many = lines.where(kind.isin(*part.values())).groupBy(*keys, "item_type", "item_name").agg(F.collect_list(seq).alias("_at"))
    spread = F.transform("_at", lambda s: F.struct(s.alias("s"), name.alias("n")))
    many = many.groupBy(*keys).agg(*[joined(F.flatten(F.collect_list(F.when(kind == v, spread))), ", ").alias(f"{t}_list") for t, v in part.items()])

    menu = clean_item_name("menu_name")
    menus = lines.where(~text("menu_name").rlike(FEE_MENUS)).withColumn("_menu", menu).where(F.coalesce(F.col("_menu"), F.lit("")) != "")
    menus = menus.groupBy(*keys, "_menu").agg(F.min(seq).alias("s"))
    menus = menus.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("s", F.col("_menu").alias("n")))), lambda x: x["n"]).alias("_menus"))

    for right in (many, menus):
        theirs = right.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        g = g.join(theirs, same, "left").drop(*[f"_{k}" for k in keys])
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    split_menus = ~F.col("_hall") & F.col("_menus").isNotNull()
    return g.withColumns({f"{t}_list": F.coalesce(f"{t}_list", F.lit("")) for t in part}).withColumn(
        "final_menu_name",
        F.when(split_menus, F.array_join("_menus", " | ")).otherwise(
            F.concat_ws(" ", some("size_option"), some("protein_option"), some("main_menu"))
        ),
    ).withColumn("main_menu", F.when(split_menus, F.element_at("_menus", 1)).otherwise(F.col("main_menu"))).drop("_hall", "_menus")
