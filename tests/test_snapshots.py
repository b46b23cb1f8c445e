"""Snapshots read and write only the buckets that differ."""

import io
import re
from contextlib import redirect_stdout

import pytest

from tillbook.session import fresh_path
from tillbook.sources.snapshots import Snapshot

KIND = "k int, name string, price int, note string"


def test_changes_by_buckets(spark, monkeypatch):
    rows = [(i, f"n{i}", i, "x") for i in range(300)] + [(None, "no key", 1, "x")]
    df = lambda given: spark.createDataFrame(given, KIND)
    s = Snapshot(spark, fresh_path(spark, "snap"), df([]).schema, ["k"], ["name", "price"], buckets=32)
    assert len(s.update(df(rows))) == 32 and s.update(df(rows[::-1])) == []
    # An untracked column is no change; a null is not an empty text.
    new = [(k, n, p, "other") for k, n, p, _ in rows]
    assert s.update(df(new)) == []
    new[5], new[7] = (5, None, 5, "x"), (7, "n7", 70, "x")
    new = [r for r in new if r[0] != 9] + [(1000, "new", 1, "x")]
    found = s.changes(df(new))
    assert sorted((r.k, r.change_type) for r in found.collect()) == [(5, "변경"), (7, "변경"), (1000, "신규")]
    text = io.StringIO()
    with redirect_stdout(text):
        found.explain()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket", text.getvalue())
    # Stopped between rows and sums, the same buckets are written again.
    monkeypatch.setattr(s.sums, "replace", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        s.update(df(new))
    monkeypatch.undo()
    assert 0 < len(s.update(df(new))) <= 4 and s.update(df(new)) == []
    assert sorted((tuple(r)[:3] for r in s.latest().collect()), key=repr) == sorted((r[:3] for r in new), key=repr)
