"""Nearest quotes by a two-sided carry against trying all quotes."""

import datetime as dt
import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tillbook.operators import joins as j
from tillbook.operators.core import HOT_CONF


@pytest.mark.parametrize("hot", [None, "20"])
def test_nearest_against_all_quotes(spark, hot):
    rng = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    quotes = [(rng.choice("abc"), day(rng.randrange(200)), rng.choice([None, *range(1, 90)])) for _ in range(90)] + [(None, day(3), 5), ("a", None, 5)]
    asked = [(rng.choice("abcd"), day(rng.randrange(220))) for _ in range(120)] + [(None, day(3)), ("a", None), ("a", dt.date(2024, 3, 31)), ("a", dt.date(2024, 3, 30))]
    q = spark.createDataFrame(quotes, "k string, base_date date, price int")
    left = spark.createDataFrame(asked, "k string, base_date date")
    if hot:
        spark.conf.set(HOT_CONF, hot)
    try:
        out = j.nearest_asof(left, q, "k", F.add_months("base_date", -1), 7, "found")
        got = sorted(map(repr, (tuple(r) for r in out.collect())))
        text = io.StringIO()
        with redirect_stdout(text):
            out.explain()
    finally:
        spark.conf.unset(HOT_CONF)
    goal = dict(zip(asked, [r[0] for r in left.select(F.add_months("base_date", -1)).collect()], strict=True))
    want = []
    for k, d in asked:
        t = goal[k, d]
        near = [(abs((b - t).days), b, p is not None, p) for x, b, p in quotes if k is not None and d is not None and x == k and b is not None and abs((b - t).days) <= 7]
        want.append(repr((k, d, min(near, key=lambda n: n[:3] + (n[3] or 0,))[3] if near else None)))
    assert got == sorted(want)
    assert "explode" not in text.getvalue().lower() and "Generate" not in text.getvalue()
