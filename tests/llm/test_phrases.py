"""Collocations against counting every phrase, with forced rounds, slices and early writing out."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tillbook.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_version(rows, min_count=10, limit=2000, contained=50):
    f = defaultdict(Counter)
    for lang, text in rows:
        counts = f["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) == 1 or a < min_count:
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = max((b for q, b in counts.items() if len(q) == 3 and b >= min_count and p in (q[:2], q[1:])), default=0) if len(p) == 2 else 0
            if 100 * longer < contained * a or not longer:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        n = sum(c for p, c in counts.items() if len(p) == 1)
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def made(seed=1, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢", "Ab", " "]
    sets = [["New", "York", "City"], ["hot", "dog"], ["ad", "hoc"], ["x", "x", "x"]]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice(sets) if rng.random() < 0.2 else [rng.choices(vocabulary, weights=range(44, 0, -1))[0]]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "; "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", "", None]), text))
    return rows + [("fr", None), (None, ""), ("one", "word " * 9), ("two", "only these two " * 12), ("en", rows[0][1])]


ROWS = made()


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("options", [{}, {"limit": 5, "start": 1}, {"limit": 25, "start": 3, "min_count": 3}, {"limit": 12, "start": 6, "contained": 90}])
def test_against_counting_every_phrase(spark, options):
    """A small start forces further rounds: the first floor leaves too few survivors."""
    plain = {k: v for k, v in options.items() if k != "start"}
    assert run(spark, ROWS, **options) == plain_version(ROWS, **plain)


def test_slices_and_early_writing_out(spark, monkeypatch):
    for name, value in (("SLICE", 64), ("HELD_WORDS", 20), ("HELD_CODES", 50)):
        monkeypatch.setattr(phrases, name, value)
    assert run(spark, ROWS, limit=40, start=10) == plain_version(ROWS, limit=40)


def test_wrong_hits_in_the_bit_tables_change_nothing(spark, monkeypatch):
    """With tables of a page all bits are soon set, so every phrase is counted."""
    for name in ("MIN_BITS", "MAX_BITS"):
        monkeypatch.setattr(phrases, name, 8 * phrases.PAGE)
    monkeypatch.setattr(phrases, "pair_hash", lambda a, b: a * 0 + b * 0)
    assert run(spark, ROWS, limit=30) == plain_version(ROWS, limit=30)


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(4_000_000_000_000, 4_000_000_000_001, 4_000_000_000_003)], "n long, f1 long, f2 long")
    a, l, r = df.first()
    assert df.select(phrases.floor_ratio([1_000_000, "n", "n"], ["f1", "f2"])).first()[0] == 1_000_000 * a * a // (l * r)
