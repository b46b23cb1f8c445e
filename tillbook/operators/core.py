"""Shared building blocks: deduplication, whole-group values, running values, ranks.

Group keys may be badly skewed, so none of these lets one task see a whole
unbounded group:

* ``keep_one`` / ``top_k`` filter a ranking window; Spark prunes each map
  partition to k rows per key before the shuffle (WindowGroupLimit).
* ``attach`` and ``running`` use plain windows for ordinary groups (one shuffle,
  shared by all windows on the same key). Groups above ``hot_limit`` rows take
  another way: whole-group values are partial aggregates joined back, running
  values go through a range partitioning on (key, order) whose slices carry
  their totals on. Which keys are hot is counted once, on the key column alone.

No join here carries a broadcast hint: Spark broadcasts a side when its known
size is below ``autoBroadcastJoinThreshold`` (or AQE's measured size is), and
shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.session import reliable_checkpoint

HOT_GROUP_ROWS = 2_000_000
#: Session setting that replaces HOT_GROUP_ROWS: the rows that one task can well hold of a group.
HOT_CONF = "spark.tillbook.hotGroupRows"

SLICE_ROWS = 250_000_000
#: Session setting that replaces SLICE_ROWS: the rows that the disks can well hold in the shuffles of a job at a time.
SLICE_CONF = "spark.tillbook.sliceRows"


def hot_limit(spark) -> int:
    return int(spark.conf.get(HOT_CONF, str(HOT_GROUP_ROWS)))


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key under ``order`` (columns or ``.desc()`` expressions)."""
    return top_k(df, keys, order, 1).drop("_rank")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, rank: str = "_rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[col(c) for c in order])
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


AUTO, ALL = "auto", "all"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, None when there are none.

    At most rows / hot_rows keys come out; they are checkpointed, not collected.
    """
    return hot_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), hot_rows)


def hot_counts(sizes: DataFrame, hot_rows: int | None = None) -> DataFrame | None:
    """The same from counts (keys, _n) that a job has already."""
    limit = hot_limit(sizes.sparkSession) if hot_rows is None else hot_rows
    found = reliable_checkpoint(sizes.where(F.col("_n") > limit).drop("_n"))
    return None if found.isEmpty() else found


def hot_and_rows(sizes: DataFrame) -> tuple[DataFrame | None, int]:
    """(hot keys or None, rows of all keys) from counts (keys, _n), in one pass: the rows of ordinary keys are added up under no key."""
    keys = F.struct(*[c for c in sizes.columns if c != "_n"])
    totals = sizes.groupBy(F.when(F.col("_n") > hot_limit(sizes.sparkSession), keys).alias("_k")).agg(F.sum("_n").alias("_n"))
    found = reliable_checkpoint(totals)
    rows, hot = found.agg(F.sum("_n"), F.count("_k")).first()
    return found.where(F.col("_k").isNotNull()).select("_k.*") if hot else None, rows or 0


def slice_count(spark, rows: int, times: int) -> int:
    """In how many slices a job goes through so many rows, which it shuffles so many times."""
    return max(1, -(-rows * times // int(spark.conf.get(SLICE_CONF, str(SLICE_ROWS)))))


def slices(frames: Sequence[DataFrame], key, n: int, drop: Sequence[str] = ()) -> Iterator[list[DataFrame]]:
    """The frames' rows in ``n`` slices by a hash of ``key``, which rows that meet in the job must share; all in one for 1.

    For ``stage_all``: a job that shuffles its rows several times holds the shuffles of one slice on disk. Each slice reads the
    input again, so few large ones are best, and a key that costs little. ``drop`` are columns of the key alone.
    """
    for i in range(n):
        cut = F.pmod(F.xxhash64(col(key)), F.lit(n)) == i
        yield [(df.where(cut) if n > 1 else df).drop(*drop) for df in frames]


def resolve_hot(df: DataFrame, keys: Sequence[str], hot, hot_rows: int | None = None):
    return hot_keys(df, keys, hot_rows) if isinstance(hot, str) and hot == AUTO else hot


def split_hot(df: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups)."""
    match = null_safe(df, hot, hot.columns)
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")


def by_heat(fn):
    """Run ``fn(df, keys, ..., hot=)`` apart for ordinary and hot groups.

    ``hot`` is None (no hot groups: windows), ALL (the rows are all hot), a
    table of hot keys, or AUTO to count them first. The hot rows are written out
    once per step, so a chain of steps on them stays linear.
    """

    @wraps(fn)
    def run(df, keys, *args, hot=AUTO, **kw):
        hot = resolve_hot(df, keys, hot)
        if hot is None or isinstance(hot, str):
            return fn(df, keys, *args, hot=hot, **kw)
        cold, rows = split_hot(df, hot)
        return fn(cold, keys, *args, hot=None, **kw).unionByName(
            fn(reliable_checkpoint(rows), keys, *args, hot=ALL, **kw)
        )

    return run


@by_heat
def attach(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], hot=AUTO) -> DataFrame:
    """Add whole-group aggregates to every row."""
    keys = list(keys)
    if hot is None:
        w = Window.partitionBy(*keys)
        return df.withColumns({n: a.over(w) for n, a in aggs.items()})
    values = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggs.items()])
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(values[f"_k_{k}"]) for k in keys])
    return reliable_checkpoint(df.join(values, cond).select(*df.columns, *aggs))


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Right side of a left join that must not fan out."""
    return keep_one(df, keys, order)


def _local(df: DataFrame, part: Sequence[str], order: Sequence, specs: dict) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*[col(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = {}
    for name, (kind, expr) in specs.items():
        if kind == "count":
            out[name] = F.count(F.lit(1)).over(w)
        elif kind == "sum":
            out[name] = F.sum(col(expr)).over(w)
        else:
            out[name] = F.last(col(expr), ignorenulls=True).over(w)
    return df.withColumns(out)


def running(df: DataFrame, keys: Sequence[str], order: Sequence, specs: dict, hot=AUTO) -> DataFrame:
    """Running count / sum / last-non-null inside each group.

    ``specs`` maps an output name to ``("count", None)``, ``("sum", expr)`` or
    ``("last", expr)``. ``order`` must be total inside a group.
    """
    return by_heat(_running)(df, list(keys), order, specs, hot=hot)


def running_total(df: DataFrame, order: Sequence, specs: dict) -> DataFrame:
    """The same over the whole table as one group, always in slices."""
    return _running(df, [], order, specs, hot=ALL)


def _running(df: DataFrame, keys: Sequence[str], order: Sequence, specs: dict, hot) -> DataFrame:
    if hot is None:
        return _local(df, keys, order, specs)
    inputs = {f"_in_{n}": col(e) for n, (k, e) in specs.items() if k != "count"}
    local_specs = {n: (k, f"_in_{n}" if k != "count" else None) for n, (k, _) in specs.items()}
    sliced = reliable_checkpoint(
        df.withColumns(inputs).repartitionByRange(*[col(c) for c in [*keys, *order]])
        .withColumn("_slice", F.spark_partition_id())
    )
    rows = _local(sliced, [*keys, "_slice"], order, local_specs)
    ends = []
    for name, (kind, _) in specs.items():
        if kind == "count":
            ends.append(F.count(F.lit(1)).alias(f"_end_{name}"))
        elif kind == "sum":
            ends.append(F.sum(f"_in_{name}").alias(f"_end_{name}"))
        else:
            ends.append(F.max_by(name, "_at").alias(f"_end_{name}"))
    marked = _local(sliced, [*keys, "_slice"], order, {**local_specs, "_at": ("count", None)})
    totals = marked.groupBy(*keys, "_slice").agg(*ends)
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        *[
            (F.last(f"_end_{n}", ignorenulls=True) if kind == "last" else F.sum(f"_end_{n}")).over(before).alias(f"_c_{n}")
            for n, (kind, _) in specs.items()
        ],
    )
    cond = rows["_slice"] == carries["_k_slice"]
    for k in keys:
        cond = cond & rows[k].eqNullSafe(carries[f"_k_{k}"])
    joined = rows.join(carries, cond, "left")
    for name, (kind, _) in specs.items():
        carry = F.col(f"_c_{name}")
        if kind == "last":
            value = F.coalesce(F.col(name), carry)
        elif kind == "count":
            value = F.col(name) + F.coalesce(carry, F.lit(0))
        else:
            value = F.when(F.col(name).isNull(), carry).when(carry.isNull(), F.col(name)).otherwise(F.col(name) + carry)
        joined = joined.withColumn(name, value)
    return reliable_checkpoint(joined.select(*df.columns, *specs))


def global_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Competition rank (largest first) over the whole table.

    Ranks the distinct values, not the rows, so the ordered part is small.
    """
    per_value = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(per_value, [F.col("_v").desc()], {"_upto": ("sum", "_n")})
    ranks = ranked.select("_v", (F.col("_upto") - F.col("_n") + 1).alias(out))
    return df.join(ranks, df[value] == ranks["_v"], "left").drop("_v")
