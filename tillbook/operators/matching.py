"""Text labels from rules and labelled examples, and text-derived rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.clean import text
from tillbook.operators.core import col, keep_one, top_k
from tillbook.session import stage


def keyword_label(
    c, rules: Sequence[tuple[str, Sequence[str]]], default: str, main: str = "", main_words: Sequence[str] = (), topping: Sequence[str] = ()
) -> Column:
    """First label in decision order with a keyword in the text; main words win unless a topping word is there."""
    t = text(c)
    has = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: t.contains(w)) if words else F.lit(False)
    out = F.lit(default)
    for label, words in reversed(list(rules)):
        out = F.when(has(words), label).otherwise(out)
    return F.when(has(main_words) & ~has(topping), main).otherwise(out) if main_words else out


def tokens(c) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text(c)), r"[^\p{L}\p{N}]+"), lambda x: x != ""))


#: Examples that a token may be in to join items with examples; more frequent tokens join groups of them.
FREQUENT = 1000


def token_overlap_match(
    items: DataFrame, examples: DataFrame, key: str, name: str, label: str = "label", threshold: int = 70, evidence: int = 5, frequent: int = FREQUENT
) -> DataFrame:
    """Best labelled example per item by shared tokens / larger token count; an equal name scores 100.

    Distinct names are matched with examples merged per (name, label). Tokens in up to ``frequent`` examples join both, so a
    token of an item makes at most that many pairs, which are then verified on all tokens. Two names that share only more
    frequent tokens have a score that depends on these and the token counts alone: such names are grouped by their frequent
    tokens and count, examples also by label, and the groups are joined. An item's score with a label is the better of both
    ways; of its group the first ``evidence`` labels suffice.
    """
    norm = F.array_join(F.array_sort(tokens(name)), " ")
    full = F.regexp_replace(F.lower(text(name)), r"\s+", "")
    # Names, examples and their words are written out: plans stay short, and Spark knows the size of what it joins.
    names = stage(items.select(F.col(name).alias("_i_name"), norm.alias("_i_norm"), full.alias("_i_full")).distinct())
    ex = stage(examples.select(F.col(label).alias("_label"), norm.alias("_e_norm"), full.alias("_e_full")).distinct())
    i_words = _words(names.select(F.col("_i_norm").alias("_norm")).distinct())
    e_words = _words(ex.select(F.col("_e_norm").alias("_norm")).distinct())
    often = stage(e_words.groupBy("_w").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > frequent).select("_w", F.lit(True).alias("_often")))
    i_words, e_words = (stage(w.join(often, "_w", "left").withColumn("_often", F.coalesce("_often", F.lit(False)))) for w in (i_words, e_words))
    # Pairs that share a rare token, verified on all tokens.
    rare = lambda w, n: w.where(~F.col("_often")).select("_w", F.col("_norm").alias(n))
    shared = rare(i_words, "_i_norm").join(rare(e_words, "_e_norm").hint("merge"), "_w").select("_i_norm", "_e_norm").distinct()
    i, e = F.split("_i_norm", " "), F.split("_e_norm", " ")
    score = F.floor(100 * F.size(F.array_intersect(i, e)) / F.greatest(F.size(i), F.size(e))).cast("int")
    found = shared.withColumn("_score", score).join(ex.select("_label", "_e_norm"), "_e_norm").join(names.select("_i_name", "_i_norm"), "_i_norm")
    # Equal names that share a token.
    equal = names.join(ex, names["_i_full"] == ex["_e_full"]).where(F.size(F.filter(F.array_intersect(i, e), lambda w: w != "")) > 0)
    best = found.select("_i_name", "_label", "_score").unionByName(equal.select("_i_name", "_label", F.lit(100).alias("_score")))
    best = best.unionByName(_frequent_matches(names, ex, i_words, e_words, evidence)).groupBy("_i_name", "_label").agg(F.max("_score").alias("_score"))
    ranked = top_k(best, ["_i_name"], [F.col("_score").desc(), F.col("_label")], evidence)
    text_of = F.concat(F.col("_label"), F.lit(":"), F.col("_score").cast("string"))
    out = ranked.groupBy("_i_name").agg(
        F.max("_score").alias("confidence"), F.min_by("_label", "_rank").alias("_top"),
        F.array_sort(F.collect_list(F.struct("_rank", text_of.alias("t")))).alias("_l"),
    ).select(
        "_i_name", "confidence", F.when(F.col("confidence") >= threshold, F.col("_top")).otherwise("").alias("matched_label"),
        F.array_join(F.transform("_l", lambda x: x["t"]), ", ").alias("evidence"),
    )
    return items.select(key, name).join(out, items[name] == out["_i_name"], "left").drop("_i_name").withColumns(
        {"confidence": F.coalesce("confidence", F.lit(0)), "matched_label": F.coalesce("matched_label", F.lit("")), "evidence": F.coalesce("evidence", F.lit(""))}
    )


def _words(norms: DataFrame) -> DataFrame:
    """(_norm, _size, _w): the tokens of normalised names."""
    words = norms.withColumn("_words", F.split("_norm", " "))
    return words.select("_norm", F.size("_words").alias("_size"), F.explode("_words").alias("_w")).where(F.col("_w") != "")


def _frequent_matches(names: DataFrame, ex: DataFrame, i_words: DataFrame, e_words: DataFrame, evidence: int) -> DataFrame:
    """(_i_name, _label, _score) by frequent tokens alone: the first labels of each group of names."""
    grouped = lambda words: words.where("_often").groupBy("_norm", "_size").agg(F.array_join(F.array_sort(F.collect_list("_w")), " ").alias("_set"))
    i_groups, e_groups = grouped(i_words), grouped(e_words).join(ex.select(F.col("_e_norm").alias("_norm"), "_label"), "_norm")
    of = lambda groups, *more: groups.select(*more, "_set", "_size").distinct().withColumn("_w", F.explode(F.split("_set", " ")))
    # Spark takes exploded rows for as small as what they come from; none of them is broadcast.
    left = of(i_groups).withColumnsRenamed({"_set": "_i_set", "_size": "_i_size"})
    right = of(e_groups, "_label").withColumnsRenamed({"_set": "_e_set", "_size": "_e_size"})
    shared = left.join(right.hint("merge"), "_w").groupBy("_i_set", "_i_size", "_e_set", "_e_size", "_label").agg(F.count(F.lit(1)).alias("_s"))
    score = F.floor(100 * F.col("_s") / F.greatest("_i_size", "_e_size")).cast("int")
    best = shared.groupBy("_i_set", "_i_size", "_label").agg(F.max(score).alias("_score"))
    first = top_k(best, ["_i_set", "_i_size"], [F.col("_score").desc(), F.col("_label")], evidence).drop("_rank")
    mine = i_groups.join(first, (F.col("_set") == F.col("_i_set")) & (F.col("_size") == F.col("_i_size")))
    return mine.join(names.select("_i_name", F.col("_i_norm").alias("_norm")), "_norm").select("_i_name", "_label", "_score")


def label_override_chain(items: DataFrame, overrides: DataFrame, rule: Column, unknown: str = "미분류") -> DataFrame:
    """Manual label by item key, then id, then name (the last one given wins), else the rule's label.

    ``overrides``: item_pk, item_id, item_name, item_type, pos.
    """
    given = overrides.where((text("item_type") != "") & (F.col("item_type") != unknown))
    out = items
    for k in ("item_pk", "item_id", "item_name"):
        look = keep_one(given.where(text(k) != ""), [k], [F.col("pos").desc()]).select(k, F.col("item_type").alias(f"_by_{k}"))
        out = out.join(look, k, "left")
    label = F.coalesce("_by_item_pk", "_by_item_id", "_by_item_name", rule)
    by = F.when(F.coalesce("_by_item_pk", "_by_item_id", "_by_item_name").isNotNull(), "manual").otherwise("rule")
    return out.withColumns({"item_type": label, "classified_by": by}).drop("_by_item_pk", "_by_item_id", "_by_item_name")


def label_train_stats(df: DataFrame, label: str, example: str, n: int = 3) -> DataFrame:
    """Rows, distinct examples and the most frequent examples per label."""
    counts = df.groupBy(label, example).agg(F.count(F.lit(1)).alias("_n"))
    base = counts.groupBy(label).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("examples"))
    best = top_k(counts, [label], [F.col("_n").desc(), F.col(example)], n)
    top = best.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("_rank", F.col(example).alias("e")))).alias("_l"))
    top = top.select(label, F.array_join(F.transform("_l", lambda x: x["e"]), ", ").alias("top_examples"))
    return base.join(top, label)


def false_positive_rules(df: DataFrame, c: str, rules: Sequence[tuple[str, str, str, str | None]]) -> DataFrame:
    """Correct multi-label flags by text: (words, flag, detail column values, replacement or None).

    When the text holds one of the words, the flag is set and its detail is one
    of the '|'-separated values, the flag is cleared, or its detail replaced.
    """
    out = df
    for words, flag, details, replacement in rules:
        hit = F.col(c).rlike(words) & (F.col(flag) == 1) & F.col(f"{flag}_detail").isin(details.split("|"))
        hit = F.coalesce(hit, F.lit(False))
        if replacement is None:
            out = out.withColumns({flag: F.when(hit, 0).otherwise(F.col(flag)), f"{flag}_detail": F.when(hit, "해당없음").otherwise(F.col(f"{flag}_detail"))})
        else:
            out = out.withColumn(f"{flag}_detail", F.when(hit, replacement).otherwise(F.col(f"{flag}_detail")))
    return out


ISSUE = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("has_issue", T.BooleanType()), T.StructField("priority", T.IntegerType()), T.StructField("detail", T.StringType())]))


def flatten_multi_label(df: DataFrame, key: str, json: str, none_type: str = "특이사항없음") -> DataFrame:
    """One row per (note, issue) in priority order, numbered from 1; a note without issues gives one 'nothing' row."""
    hits = F.filter(F.from_json(json, ISSUE), lambda x: x["has_issue"])
    ordered = F.array_sort(F.transform(hits, lambda x, i: F.struct(x["priority"].alias("p"), i.alias("i"), x["type"].alias("t"), x["detail"].alias("d"))))
    none = F.array(F.struct(F.lit(4).alias("p"), F.lit(0).alias("i"), F.lit(none_type).alias("t"), F.lit("").alias("d")))
    rows = F.when(F.size(ordered) > 0, ordered).otherwise(none)
    return df.select(key, F.posexplode(rows).alias("_pos", "_x")).select(
        key, (F.col("_pos") + 1).alias("priority"), F.col("_x.t").alias("type"), F.col("_x.d").alias("detail")
    )


def unit_price_vote(price, qty, master_price) -> Column:
    """Raw price, or price / quantity when that is nearer to the master price."""
    p, q, m = col(price), col(qty), col(master_price)
    each = F.bround((p.cast("double") / F.when(q != 0, q).otherwise(1)).cast("decimal(30,8)"), 0).cast("bigint")
    use = (F.coalesce(m, F.lit(0)) > 0) & (F.abs(each - m) < F.abs(p - m))
    return F.when(use, each).otherwise(p)


# Log lines that are no errors.
LOG_NOISE = "received sigterm|::endgroup:|local_task_job_runner\\.py"


def log_error_extract(logs: DataFrame, key: str, body: str, mark: str = "error|exception", keep: int = 40) -> DataFrame:
    """Per log: lines that name an error, the last line that does or starts with a capital, and the last traceback.

    Noise is left out and no line is cut. The excerpt has ``keep`` lines from the last one that says Traceback, or else
    the last ``keep``; blank ones are dropped. Without a telling line its last line is the summary.
    """
    every = F.split(F.coalesce(body, F.lit("")), "\n")
    lines = logs.select(key, F.size(every).alias("_size"), F.posexplode(every).alias("line_no", "line"))
    low = F.lower("line")
    plain = (F.trim("line") != "") & ~low.contains("traceback") & ~low.rlike(LOG_NOISE)
    named, capital = plain & low.rlike(mark), plain & F.trim("line").rlike("^[A-Z]")
    at = F.when(named | capital, F.col("line_no"))
    found = lines.groupBy(key).agg(
        F.count_if(named).alias("error_lines"), F.max(at).alias("last_line_no"), F.max_by(F.trim("line"), at).alias("summary"),
        F.coalesce(F.max(F.when(F.col("line").contains("Traceback"), F.col("line_no"))), F.greatest(F.max("_size") - keep, F.lit(0))).alias("_from"),
    )
    shown = lines.join(found.select(key, "_from"), key).where(F.col("line_no").between(F.col("_from"), F.col("_from") + keep - 1) & (F.trim("line") != ""))
    shown = shown.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", F.rtrim("line").alias("t")))).alias("_l"))
    shown = shown.select(key, F.transform("_l", lambda x: x["t"]).alias("_l"))
    out = found.join(shown, key, "left")
    return out.select(
        key, "error_lines", "last_line_no", F.coalesce("summary", F.trim(F.element_at(F.col("_l"), -1))).alias("summary"),
        F.trim(F.array_join("_l", "\n")).alias("excerpt"),
    )
