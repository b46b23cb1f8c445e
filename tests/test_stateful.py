"""Ingest with state per key: repetitions dropped, corrections applied, late rows kept aside, failures without effect."""

import datetime as dt

import pytest

from tillbook.session import fresh_path
from tillbook.sources import versions as vt, writers as wr
from tillbook.streaming.ingest import StatefulIngest

ROW = "id string, d string, ym string, v long, at timestamp, raw binary, sent int"
BIG = (1 << 60) + 1
AT = dt.datetime(2024, 3, 1, 1, 2, 3, 456789)


@pytest.fixture
def place(spark):
    schema = spark.createDataFrame([], ROW).schema
    kept = spark.createDataFrame([], ROW + ", changed_in long").schema
    tables = vt.new_table(spark, kept, ["ym"]), vt.new_table(spark, kept, ["changed_in"]), vt.new_table(spark, spark.createDataFrame([], "newest string, changed_in long").schema, ["changed_in"])
    inbox, checkpoint = fresh_path(spark, "in"), fresh_path(spark, "stream")

    def job():  # a new one each time, as an hourly job is
        return StatefulIngest(spark, inbox, schema, *tables, ["id"], "d", "sent", checkpoint, late_days=7)

    def drop(name, *rows):
        given = [(i, d, d[:7], v, AT, b"\x00\xff", sent) for i, d, v, sent in rows]
        wr.write_table(spark.createDataFrame(given, ROW).repartition(2), f"{inbox}/{name}")

    return job, drop, tables


def held(table):
    return sorted((r.id, r.v, r.changed_in) for r in table.read().collect())


def test_a_week_of_deliveries(spark, place, monkeypatch):
    job, drop, (table, late, _) = place
    drop("a", ("x", "2024-03-01", BIG, 1), ("y", "2024-03-20", None, 1), ("y", "2024-03-20", 1, 0))
    assert job().run() == [{"batch": 0, "rows": 2, "late": 0}]
    assert held(table) == [("x", BIG, 0), ("y", None, 0)]
    assert {(r.at, bytes(r.raw)) for r in table.read().collect()} == {(AT, b"\x00\xff")}
    # Repeated, corrected, stale and late rows.
    drop("b", ("x", "2024-03-01", BIG, 1), ("y", "2024-03-20", 5, 2), ("z", "2024-03-21", 7, 1), ("old", "2024-01-01", 9, 1))
    assert job().run() == [{"batch": 1, "rows": 3, "late": 1}]
    drop("c", ("y", "2024-03-20", 4, 1), ("x", "2024-03-01", BIG, 1))
    assert job().run() == [{"batch": 2, "rows": 0, "late": 0}]
    assert held(table) == [("x", BIG, 0), ("y", 5, 1), ("z", 7, 1)] and held(late) == [("old", 9, 1)]
    # Back to an earlier content is a change.
    drop("d", ("y", "2024-03-20", None, 3), ("z", "2024-03-21", 8, 2))
    # The job stops after the table is published; the batch runs again and finds its tag.
    done = vt.VersionedTable.merge

    def stops(self, new, how, tag=None):
        out = done(self, new, how, tag)
        if self is table:
            raise OSError("lost")
        return out

    monkeypatch.setattr(vt.VersionedTable, "merge", stops)
    with pytest.raises(Exception, match="lost"):
        job().run()
    monkeypatch.undo()
    n = len(table.versions())
    assert [r["batch"] for r in job().run()] == [3] and len(table.versions()) == n
    assert held(table) == [("x", BIG, 0), ("y", None, 3), ("z", 8, 3)]
    # A late row that was corrected on time since stays corrected.
    assert job().merge_late() == 1 and job().merge_late() == 0
    assert held(table) == [("old", 9, 1), ("x", BIG, 0), ("y", None, 3), ("z", 8, 3)] and held(late) == []
