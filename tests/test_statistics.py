"""p values and regression diagnostics against plain references."""

import math

import numpy as np
from pyspark.sql import functions as F

from tillbook.operators import statistics as st


def plain_p(t, n, steps=100_001):
    """Simpson's rule over the density of t, in long doubles."""
    u = np.linspace(0, min(abs(t), 60), steps, dtype=np.longdouble)
    f = (1 + u * u / n) ** (-(np.longdouble(n) + 1) / 2)
    w = np.full(steps, 2.0, np.longdouble)
    w[1::2], w[0], w[-1] = 4, 1, 1
    a = n / 2
    ratio = 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) if a > 1000 else math.lgamma(a + 0.5) - math.lgamma(a)
    return float(1 - 2 * (f * w).sum() * (u[1] - u[0]) / 3 * np.exp(np.longdouble(ratio)) / np.sqrt(np.pi * np.longdouble(n)))


def test_p_values(spark):
    cases = [(t, n) for n in (1, 2, 3, 7, 30, 79, 81, 1000, 60_000, 99_999, 100_001, 10**7) for t in (1e-4, -0.3, 1.0, 1.7, -2.5, 6.0)]
    found = spark.createDataFrame(cases, "t double, n long").withColumn("p", st.t_p_value(F.col("t"), F.col("n"))).collect()
    assert max(abs(r.p - plain_p(r.t, r.n)) for r in found) < 1e-9
    odd = spark.createDataFrame([(0.0, 5), (None, 5), (1.0, 0), (float("nan"), 5)], "t double, n long").withColumn("p", st.t_p_value(F.col("t"), F.col("n")))
    assert [r.p for r in odd.collect()] == [1.0, None, None, None]
    far = spark.createDataFrame([(50.0, 200), (40.0, 10**6)], "t double, n long").withColumn("p", st.t_p_value(F.col("t"), F.col("n")))
    assert all(0 <= r.p < 1e-100 for r in far.collect())


def test_regression_against_matrices(spark):
    rng = np.random.default_rng(3)
    n = 400
    a, b = rng.normal(50, 5, n), rng.normal(0, 1, n)
    y = 3 + 0.7 * a - 2 * b + 0.1 * a * b + rng.normal(0, 1 + np.abs(b), n)
    rows = [tuple(map(float, r)) for r in zip(y, a, b, strict=True)] + [(None, 1.0, 1.0), (1.0, None, 2.0)]
    found = {r.term: r for r in st.regression(spark.createDataFrame(rows, "y double, a double, `b b` double"), "y", ["a", "b b"], [("a", "b b")]).collect()}
    x = np.column_stack([a, b, a * b, np.ones(n)])
    inverse = np.linalg.inv(x.T @ x)
    coefficients = inverse @ x.T @ y
    e = y - x @ coefficients
    s2 = e @ e / (n - 4)
    leverage = np.einsum("ij,jk,ik->i", x, inverse, x)
    hc3 = inverse @ (x.T * (e / (1 - leverage)) ** 2) @ x @ inverse
    for i, term in enumerate(["a", "b b", "a:b b", "(intercept)"]):
        r = found[term]
        want = [coefficients[i], math.sqrt(s2 * inverse[i, i]), math.sqrt(hc3[i, i])]
        assert np.allclose([r.coefficient, r.std_error, r.std_error_hc3], want, rtol=1e-8)
        assert abs(r.p - plain_p(want[0] / want[1], n - 4)) < 1e-8 and r.n == n
    for i, term in enumerate(["a", "b b", "a:b b"]):
        others = np.delete(x, i, axis=1)
        rest = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert math.isclose(found[term].vif, ((x[:, i] - x[:, i].mean()) ** 2).sum() / (rest @ rest), rel_tol=1e-7)
    r = found["a"]
    assert math.isclose(r.r2, 1 - e @ e / ((y - y.mean()) ** 2).sum(), rel_tol=1e-9)
    skew, kurtosis = (e**3).mean() / (e**2).mean() ** 1.5, (e**4).mean() / (e**2).mean() ** 2
    assert math.isclose(r.jarque_bera, n / 6 * (skew**2 + (kurtosis - 3) ** 2 / 4), rel_tol=1e-7)
