"""Fill-in-middle against a plain version that walks the lines, and round trips."""

import hashlib
import re

import pytest

from tillbook.llm import infill

ROWS = [
    (1, "one\ntwo\nthree\n"),
    (2, "one\ntwo\nno end"),
    (3, ""),
    (4, None),
    (5, "\n\n\n"),
    (6, "has <S> inside\nand more"),
    (7, "a <\nS> b <P\n> c < M >\n"),
    (8, "é漢\n\U0001f600 ü\r\nlast"),
    (9, "x" * 300_000),
    (10, "line\n" * 40_000),
    (None, "no id\nhere"),
    (11, "same\nrows\n"),
    (11, "same\nrows\n"),
    (12, "<<P\n<<M\n>"),
] + [(100 + i, "\n".join(f"w{i} {j}" for j in range(i % 7)) + "\n" * (i % 3)) for i in range(120)]


def plain_version(doc_id, text, seed=7, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = marks
    form, out = ("spm", s + suf + p + pre + m + mid) if h4 % 100 < spm else ("psm", p + pre + s + suf + m + mid)
    return n, form, len(pre), len(mid), out


@pytest.mark.parametrize("options", [{}, {"rate": 40, "spm": 0, "seed": 3}, {"spm": 100, "sentinels": ("[a]", "[b]", "[c]")}])
def test_against_walking_the_lines(spark, options):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    out = infill.transform(df, **options)
    marks = options.get("sentinels", ("<P>", "<S>", "<M>"))
    plain = {k: v for k, v in options.items() if k != "sentinels"}
    again = infill.restored(out["output"], out["form"], marks)
    got = out.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", again.alias("again")).collect()
    assert sorted(map(repr, (r[:7] for r in got))) == sorted(repr((d, t, *plain_version(d, t, marks=marks, **plain))) for d, t in ROWS)
    assert all(r.again == (r.text or "") for r in got)
    if not options:
        assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_other_units_and_columns_with_its_names(spark):
    df = spark.createDataFrame([(1, "ab cd  ef", 5, "x")], "doc_id long, text string, n int, output string")
    row = infill.transform(df, unit=r"[^ ]*+ |[^ ]++").first()
    assert row.n == 4 and row.__fields__ == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_sentinels_that_overlap_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (("<P>", "<P>", "<M>"), ("aba", "x", "y"), ("ab", "bc", "z"), ("<P>", "<S>", ""), ("<P>", "x<P>x", "<M>")):
        with pytest.raises(ValueError):
            infill.transform(df, sentinels=bad)
