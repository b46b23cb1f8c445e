"""Test statistics in closed form over one aggregate each."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.numbers import ratio, rnd
from tillbook.operators.core import running_total


#: Steps of a continued fraction; it settles in about the square root of its larger parameter.
STEPS = 400
#: Degrees of freedom from which the normal distribution, with a correction, is exact to 1e-10.
NORMAL = 100_000
#: Coefficients of the logarithm of the gamma function (Lanczos, g = 7), and where half the Stirling series takes over.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x above 0.5."""
    z = x - 1
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + k)
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(total)


def _gamma_ratio(a: Column) -> Column:
    """Logarithm of gamma(a + 1/2) / gamma(a), without the loss of digits of two large logarithms."""
    i = 1 / a
    series = 0.5 * F.log(a) - i / 8 + i * i * i / 192 - F.pow(i, F.lit(5.0)) / 640 + 17 * F.pow(i, F.lit(7.0)) / 14336
    return F.when(a > 40, series).otherwise(log_gamma(a + 0.5) - log_gamma(a))


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, by Lentz's rule over a fixed sequence of steps."""
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    first = 1 / safe(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def step(acc: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d1, c1 = 1 / safe(1 + even * acc["d"]), safe(1 + even / acc["c"])
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d2, c2 = 1 / safe(1 + odd * d1), safe(1 + odd / c1)
        return F.struct(c2.alias("c"), d2.alias("d"), (acc["h"] * d1 * c1 * d2 * c2).alias("h"))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(STEPS)), lambda m: m.cast("double")), start, step)["h"]


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p value of Student's t: the regularised incomplete beta function of df / (df + t^2) at (df / 2, 1/2)."""
    n, q = df.cast("double"), t.cast("double") * t.cast("double")
    a, b = n / 2, F.lit(0.5)
    x, y = n / (n + q), q / (n + q)
    # The power is taken of 1 + t^2 / n, as x itself may be too near 1 to tell from it.
    front = F.exp(-a * F.log1p(q / n) + 0.5 * F.log(y) + _gamma_ratio(a) - F.lit(0.5723649429247001))
    left, right = front * _fraction(a, b, x) / a, front * _fraction(b, a, y) / b
    p = F.when(n > NORMAL, _normal_tails(q, n)).when(x < (a + 1) / (a + b + 2), left).otherwise(1 - right)
    return F.when(t.isNull() | df.isNull() | (df <= 0), None).when(q == 0, 1.0).when(F.isnan(q), None).otherwise(p)


def _normal_tails(q: Column, n: Column) -> Column:
    """Two-sided p value for very many degrees of freedom: of the normal distribution, at t corrected for them."""
    z = q * F.pow(1 - 1 / (4 * n), F.lit(2.0)) / (1 + q / (2 * n)) / 2  # half the square
    # The incomplete gamma function at 1/2: a series for small z, a continued fraction, from its end, for large z.
    terms = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: k.cast("double")), F.struct(F.lit(2.0).alias("t"), F.lit(2.0).alias("s")),
        lambda acc, k: F.struct((acc["t"] * z / (k + 0.5)).alias("t"), (acc["s"] + acc["t"] * z / (k + 0.5)).alias("s")),
    )["s"]
    tail = F.aggregate(F.transform(F.sequence(F.lit(200), F.lit(1), F.lit(-1)), lambda k: k.cast("double")), F.lit(0.0), lambda acc, k: k * (k - 0.5) / (z + 2 * k + 0.5 - acc))
    scale = F.exp(-z) * F.sqrt(z) / 1.772453850905516
    return F.when(z < 2, 1 - scale * terms).otherwise(scale / (z + 0.5 - tail))


def correlation_test(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r of every column pair with n, the t statistic and its two-sided p value, all pairs from one pass."""
    pairs = list(combinations(columns, 2))
    aggs = []
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.count_if(both).alias("n"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r")).alias(f"{a}_{b}"))
    row = df.agg(*aggs)
    long = row.select(F.explode(F.array(*[F.col(f"`{a}_{b}`") for a, b in pairs])).alias("p")).select("p.*")
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0)))
    tested = long.select(*[F.col(c).alias(f"_{c}") for c in long.columns], t.alias("_t"))
    found = tested.withColumn("p", t_p_value(F.col("_t"), F.col("_n") - 2))
    return found.select(F.col("_x").alias("x"), F.col("_y").alias("y"), F.col("_n").alias("n"), rnd("_r", digits).alias("r"), rnd("_t", 4).alias("t"), "p")


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank with ties sharing their mean rank, over distinct values."""
    per = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_v").isNotNull())
    cum = running_total(per, ["_v"], {"_upto": ("sum", "_n")})
    ranks = cum.select("_v", (F.col("_upto") - (F.col("_n") - 1) / 2.0).alias(out))
    return df.join(ranks, df[value] == ranks["_v"], "left").drop("_v")


def spearman_test(df: DataFrame, a: str, b: str) -> DataFrame:
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    ranked = average_rank(average_rank(rows, a, "_ra"), b, "_rb").select("_ra", "_rb")
    return correlation_test(ranked, ["_ra", "_rb"]).select(F.lit(a).alias("x"), F.lit(b).alias("y"), "n", "r", "t", "p")


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"))


def group_compare(df: DataFrame, group: str, value: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pooled t, Welch t with its degrees of freedom and Cohen's d for named pairs of groups, from one pass."""
    v = F.col(value).cast("double")
    names = sorted({n for p in pairs for n in p})
    of = lambda n: F.when(F.col(group) == n, v)
    row = df.where(F.col(group).isin(names)).agg(
        *[F.struct(F.count(of(n)).alias("n"), F.avg(of(n)).alias("m"), F.var_samp(of(n)).alias("v")).alias(f"g_{n}") for n in names]
    )
    both = [F.struct(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), F.col(f"`g_{a}`").alias("a"), F.col(f"`g_{b}`").alias("b")) for a, b in pairs]
    j = row.select(F.explode(F.array(*both)).alias("p")).select("p.*")
    na, nb, sa, sb = F.col("a.n"), F.col("b.n"), F.col("a.v"), F.col("b.v")
    diff = F.col("a.m") - F.col("b.m")
    va, vb = sa / na, sb / nb
    pooled = ((na - 1) * sa + (nb - 1) * sb) / (na + nb - 2)
    return j.select(
        "group_a", "group_b", na.alias("n_a"), nb.alias("n_b"), rnd(diff, 4).alias("mean_diff"),
        rnd(diff / F.sqrt(pooled * (1 / na + 1 / nb)), 4).alias("t_equal"), rnd(diff / F.sqrt(va + vb), 4).alias("t_welch"),
        rnd((va + vb) * (va + vb) / (va * va / (na - 1) + vb * vb / (nb - 1)), 2).alias("welch_df"),
        rnd(diff / F.sqrt(pooled), 4).alias("cohen_d"),
    )


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F with its degrees of freedom, eta squared and Cohen's f."""
    g = group_stats(df, group, value).select(F.col("n"), F.col("mean"), F.coalesce("var", F.lit(0.0)).alias("var"))
    s = g.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("s2"), F.sum((F.col("n") - 1) * F.col("var")).alias("within"),
    ).withColumn("between", F.col("s2") - F.col("n") * F.col("grand") * F.col("grand"))
    f = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("n") - F.col("k")))
    eta = F.col("between") / (F.col("between") + F.col("within"))
    return s.select(
        (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"), rnd(f, 3).alias("f"),
        rnd(eta, 6).alias("eta_sq"), rnd(F.sqrt(eta / (1 - eta)), 5).alias("cohen_f"),
    )


def independence_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi square of a contingency table, Yates' form for 2 x 2, Cramer's V, seen cells with expected count below 5.

    Cells without rows count through the margins: chi square is n times
    (sum over seen cells of O^2 / (row total x column total) - 1). The cells stay a table; only its three totals are fetched.
    """
    cell = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = cell.groupBy(a).agg(F.sum("o").alias("ra"))
    rb = cell.groupBy(b).agg(F.sum("o").alias("rb"))
    totals = cell.agg(F.sum("o").alias("n"), F.countDistinct(a).alias("ka"), F.countDistinct(b).alias("kb")).first()
    n, ka, kb = F.lit(totals.n), F.lit(totals.ka), F.lit(totals.kb)
    o, expected = F.col("o").cast("double"), F.col("ra").cast("double") * F.col("rb") / n
    s = cell.join(ra, a).join(rb, b).agg(
        F.sum(o * o / (F.col("ra") * F.col("rb"))).alias("_q"),
        F.sum(F.pow(F.greatest(F.abs(o - expected) - 0.5, F.lit(0.0)), 2) / expected).alias("_y"),
        F.count_if(expected < 5).alias("low_expected"),
    )
    chi = n * (F.col("_q") - 1)
    return s.select(
        n.alias("n"), ((ka - 1) * (kb - 1)).alias("df"), rnd(chi, 4).alias("chi2"),
        F.when((ka == 2) & (kb == 2), rnd(F.col("_y"), 4)).alias("chi2_yates"),
        rnd(F.sqrt(F.greatest(chi, F.lit(0.0)) / (n * (F.least(ka, kb) - 1))), 6).alias("cramer_v"), "low_expected",
    )


def simple_regression(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R squared of one predictor, per key."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_count(yy, xx).alias("n"), rnd(F.regr_slope(yy, xx), 6).alias("slope"),
        rnd(F.regr_intercept(yy, xx), 4).alias("intercept"), rnd(F.regr_r2(yy, xx), 6).alias("r2"),
    )


def _sweep(matrix: list[list[Column]], k: int, own: DataFrame, name: str) -> tuple[DataFrame, list[list[Column]]]:
    """The matrix swept on its k-th place; entries become columns of ``own``, so expressions stay small."""
    n, pivot = len(matrix), matrix[k][k]
    new = {}
    for i in range(n):
        for j in range(n):
            if i == k and j == k:
                new[i, j] = 1 / pivot
            elif j == k:
                new[i, j] = -matrix[i][k] / pivot
            elif i == k:
                new[i, j] = matrix[k][j] / pivot
            else:
                new[i, j] = matrix[i][j] - matrix[i][k] * matrix[k][j] / pivot
    out = own.select("*", *[c.alias(f"{name}_{i}_{j}") for (i, j), c in new.items()])
    return out, [[F.col(f"{name}_{i}_{j}") for j in range(n)] for i in range(n)]


def _beside(rows: DataFrame, one: DataFrame) -> DataFrame:
    """rows with the columns of a table of one row, which is a scalar of the plan."""
    return rows.withColumn("_one", one.select(F.struct("*")).scalar()).select(*rows.columns, "_one.*")


def regression(df: DataFrame, y: str, xs: Sequence[str], interactions: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Least squares with interaction terms and its diagnostics, one row per term and one for the intercept.

    The Gram matrix of the centred terms comes from one aggregate; sweeping it, in columns of its one row, gives the
    coefficients, the inverse for standard errors and t, and each term's variance inflation factor. A second aggregate over the
    rows, with that one row beside them, gives the residuals' sums: errors that hold under unequal variances (HC3, by each row's
    leverage) and Jarque-Bera's skewness and kurtosis. Rows with a null in
    any column are left out. The number of terms is the caller's; nothing is collected.
    """
    terms = [*xs, *[f"{a}:{b}" for a, b in interactions]]
    k = len(terms)
    plain = [F.col(f"`{x}`").cast("double") for x in xs] + [F.col(f"`{a}`").cast("double") * F.col(f"`{b}`").cast("double") for a, b in interactions]
    rows = df.select(F.col(f"`{y}`").cast("double").alias("y"), *[p.alias(f"x{i}") for i, p in enumerate(plain)]).dropna()
    names = [*(f"x{i}" for i in range(k)), "y"]
    # Centred on the means, the matrix keeps its digits; the intercept follows from the means.
    means = rows.agg(F.count("*").cast("double").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in names])
    centred = _beside(rows, means).select("n", *[f"m_{c}" for c in names], *[(F.col(c) - F.col(f"m_{c}")).alias(c) for c in names])
    one = centred.groupBy("n", *[f"m_{c}" for c in names]).agg(*[F.sum(F.col(a) * F.col(b)).alias(f"g_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j])
    matrix = [[F.col(f"g_{min(i, j)}_{max(i, j)}") for j in range(k + 1)] for i in range(k + 1)]
    for step in range(k):
        one, matrix = _sweep(matrix, step, one, f"s{step}")
    # Now the first k places hold the inverse, the last column the coefficients, the last place the residual sum of squares.
    dof = F.col("n") - (k + 1)
    solved = one.select(
        "n", *[f"m_{c}" for c in names], dof.alias("dof"), matrix[k][k].alias("rss"), F.col(f"g_{k}_{k}").alias("tss"), *[matrix[i][k].alias(f"b{i}") for i in range(k)],
        *[matrix[i][j].alias(f"v_{i}_{j}") for i in range(k) for j in range(k)], *[F.col(f"g_{i}_{i}").alias(f"own{i}") for i in range(k)],
    )
    solved = solved.withColumn("s2", F.col("rss") / F.col("dof"))
    beside = _beside(rows, solved)
    d = [F.col(f"x{i}") - F.col(f"m_x{i}") for i in range(k)]
    e = F.col("y") - F.col("m_y")
    for i in range(k):
        e = e - F.col(f"b{i}") * d[i]
    # Row i of the inverse times the centred row: the row's share in coefficient i, and with the row its leverage.
    share = [sum((F.col(f"v_{i}_{j}") * d[j] for j in range(k)), F.lit(0.0)) for i in range(k)]
    beside = beside.select("*", e.alias("e"), *[s.alias(f"h{i}") for i, s in enumerate(share)])
    leverage = 1 / F.col("n") + sum((F.col(f"h{i}") * d[i] for i in range(k)), F.lit(0.0))
    scaled = F.pow(F.col("e") / (1 - leverage), F.lit(2.0))
    constant = 1 / F.col("n") - sum((F.col(f"h{i}") * F.col(f"m_x{i}") for i in range(k)), F.lit(0.0))
    second = beside.select(scaled.alias("w"), constant.alias("h_c"), "e", *[f"h{i}" for i in range(k)]).agg(
        *[F.sum(F.col("w") * F.col(h) * F.col(h)).alias(f"hc3_{h}") for h in [*(f"h{i}" for i in range(k)), "h_c"]],
        F.avg(F.pow("e", F.lit(2.0))).alias("e2"), F.avg(F.pow("e", F.lit(3.0))).alias("e3"), F.avg(F.pow("e", F.lit(4.0))).alias("e4"),
    )
    full = _beside(solved, second)
    r2 = 1 - F.col("rss") / F.col("tss")
    intercept = F.col("m_y") - sum((F.col(f"b{i}") * F.col(f"m_x{i}") for i in range(k)), F.lit(0.0))
    at_mean = sum((F.col(f"m_x{i}") * F.col(f"v_{i}_{j}") * F.col(f"m_x{j}") for i in range(k) for j in range(k)), F.lit(0.0))
    lines = [
        F.struct(F.lit(t).alias("term"), F.col(f"b{i}").alias("b"), F.col(f"v_{i}_{i}").alias("v"), F.col(f"hc3_h{i}").alias("hc3"), (F.col(f"v_{i}_{i}") * F.col(f"own{i}")).alias("vif"))
        for i, t in enumerate(terms)
    ]
    lines.append(F.struct(F.lit("(intercept)").alias("term"), intercept.alias("b"), (1 / F.col("n") + at_mean).alias("v"), F.col("hc3_h_c").alias("hc3"), F.lit(None).cast("double").alias("vif")))
    skew, kurtosis = F.col("e3") / F.pow("e2", F.lit(1.5)), F.col("e4") / F.pow("e2", F.lit(2.0))
    long = full.withColumn("line", F.explode(F.array(*lines))).select("*", "line.*").withColumn("std_error", F.sqrt(F.col("s2") * F.col("v")))
    t = F.col("b") / F.col("std_error")
    return long.select(
        "term", F.col("b").alias("coefficient"), "std_error", t.alias("t"), t_p_value(t, F.col("dof")).alias("p"), F.sqrt("hc3").alias("std_error_hc3"), "vif",
        F.col("n").cast("long").alias("n"), r2.alias("r2"), (1 - (1 - r2) * (F.col("n") - 1) / F.col("dof")).alias("r2_adj"),
        (r2 / k / ((1 - r2) / F.col("dof"))).alias("f"), skew.alias("skew"), kurtosis.alias("kurtosis"), (F.col("n") / 6 * (skew * skew + F.pow(kurtosis - 3, F.lit(2.0)) / 4)).alias("jarque_bera"),
    )


def linear_regression(df: DataFrame, y: str, xs: Sequence[str], interactions: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Coefficient, standard error, t and p of each term, plus R squared; ``regression`` has the diagnostics."""
    return regression(df, y, xs, interactions).select("term", "coefficient", "std_error", "t", "p", "r2", "r2_adj")
