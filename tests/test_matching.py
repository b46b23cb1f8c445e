"""Matching by shared tokens against trying all pairs, with tokens that are in every name."""

import random
import re

import pytest

from tillbook.operators import matching as mt


def plain_tokens(s):
    return {w for w in re.split(r"[\W_]+", s.lower()) if w}


def plain_version(items, examples, evidence=5, threshold=70):
    out = {}
    for key, name in items:
        best = {}
        for other, label in examples:
            a, b = plain_tokens(name), plain_tokens(other)
            if a & b:
                same = re.sub(r"\s+", "", name.lower()) == re.sub(r"\s+", "", other.lower())
                score = 100 if same else 100 * len(a & b) // max(len(a), len(b))
                best[label] = max(best.get(label, 0), score)
        first = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:evidence]
        top = first[0] if first else ("", 0)
        out[key] = (top[1], top[0] if top[1] >= threshold else "", ", ".join(f"{x}:{n}" for x, n in first))
    return out


def made(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    name = lambda n: " ".join(["set", *rng.sample(words, rng.randint(0, n)), *(["menu"] if rng.random() < 0.7 else [])])
    examples = [(name(4), f"L{rng.randrange(12):02d}") for _ in range(150)] + [("set w1w2", "joined"), ("Set  W3 menu", "L00")]
    items = list(enumerate([name(5) for _ in range(200)] + ["nothing alike", "", "set W1 W2", "set  w3 MENU", "set", "set"]))
    return items, examples


@pytest.mark.parametrize("frequent", [mt.FREQUENT, 20, 3, 0])
def test_against_all_pairs(spark, frequent):
    items, examples = made()
    df, ex = spark.createDataFrame(items, "k int, nm string"), spark.createDataFrame(examples, "nm string, label string")
    got = {r.k: (r.confidence, r.matched_label, r.evidence) for r in mt.token_overlap_match(df, ex, "k", "nm", frequent=frequent).collect()}
    assert got == plain_version(items, examples)


def test_a_token_in_every_name(spark):
    """All pairs would be nine million."""
    n = 3000
    df = spark.createDataFrame([(i, f"set only{i}") for i in range(n)], "k int, nm string")
    ex = spark.createDataFrame([(f"set other{i}", f"L{i % 7}") for i in range(n)], "nm string, label string")
    out = mt.token_overlap_match(df, ex, "k", "nm")
    assert {(r.confidence, r.evidence) for r in out.collect()} == {(50, "L0:50, L1:50, L2:50, L3:50, L4:50")}
