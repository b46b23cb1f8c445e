"""Versioned tables: a write shows whole or not at all."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tillbook.sources import versions as vt, writers as wr


@pytest.fixture
def table(spark):
    schema = spark.createDataFrame([], "id int, ym string, v int").schema
    return vt.new_table(spark, schema, ["ym"])


def rows(spark, *given):
    return spark.createDataFrame(list(given), "id int, ym string, v int")


def held(table, version=None):
    return sorted((tuple(r) for r in table.read(version).collect()), key=repr)


def newest(old, new):
    return wr.keep_last(old, new, ["id"], ["v"])


def test_partitions_are_replaced_and_versions_stay(spark, table):
    assert held(table) == [] and table.versions() == []
    table.replace(rows(spark, (1, "a", 1), (2, "b", 2), (3, None, 3)))
    table.merge(rows(spark, (2, "b", 20), (4, "b", 4), (5, "", 5)), newest)
    now = [(1, "a", 1), (2, "b", 20), (3, None, 3), (4, "b", 4), (5, None, 5)]
    assert held(table) == sorted(now, key=repr)
    assert held(table, 1) == sorted([(1, "a", 1), (2, "b", 2), (3, None, 3)], key=repr)
    table.replace(rows(spark), emptied=rows(spark, (0, "a", 0), (0, None, 0)))
    assert held(table) == [(2, "b", 20), (4, "b", 4)]
    table.rewrite(lambda df: df.where("id = 4").withColumn("ym", F.lit("c")))
    assert held(table) == [(4, "c", 4)] and table.versions() == [1, 2, 3, 4]
    assert held(table, 2) == sorted(now, key=repr)


@pytest.mark.parametrize("stop", ["staged", "entry"])
def test_a_write_that_stops_before_its_publication_leaves_the_old_version(spark, table, monkeypatch, stop):
    table.replace(rows(spark, (1, "a", 1), (2, "b", 2)))
    before = held(table)
    reader = table.read()

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(table, "_publish" if stop == "staged" else "_hadoop", fail if stop == "staged" else _fails_at(table, "log/0"))
    with pytest.raises(OSError):
        table.merge(rows(spark, (1, "a", 100), (9, "z", 9)), newest)
    monkeypatch.undo()
    assert held(table) == before == sorted((tuple(r) for r in reader.collect()), key=repr)
    assert table.versions() == [1]
    table.merge(rows(spark, (1, "a", 100), (9, "z", 9)), newest)
    assert held(table) == [(1, "a", 100), (2, "b", 2), (9, "z", 9)]
    assert len(table.vacuum(keep=2)) == 1 and held(table, 1) == before
    table.vacuum()
    assert held(table) == [(1, "a", 100), (2, "b", 2), (9, "z", 9)]


def _fails_at(table, part):
    plain = table._hadoop

    def run(path):
        if part in path:
            raise OSError("lost")
        return plain(path)

    return run


def test_a_reader_keeps_its_version_while_others_write(spark, table):
    table.replace(rows(spark, (1, "a", 1), (2, "b", 2)))
    reader = table.read()
    table.merge(rows(spark, (1, "a", 100)), newest)
    table.rewrite(lambda df: df.where("id = 2"))
    assert sorted(tuple(r) for r in reader.collect()) == [(1, "a", 1), (2, "b", 2)]


def test_the_second_writer_of_a_version_fails_and_may_try_again(spark, table):
    table.replace(rows(spark, (1, "a", 1)))
    table.replace(rows(spark, (2, "b", 2)), base=1)
    with pytest.raises(vt.Conflict):
        table.replace(rows(spark, (3, "c", 3)), base=1)
    assert held(table) == [(1, "a", 1), (2, "b", 2)]
    table.merge(rows(spark, (3, "c", 3)), newest)
    assert held(table) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]


def test_tags_are_published_with_the_rows(spark, table):
    table.replace(rows(spark, (1, "a", 1)), tag="monday")
    table.replace(rows(spark), tag="empty delivery")
    assert table.applied("monday") and table.applied("empty delivery") and not table.applied("tuesday")
    assert held(table) == [(1, "a", 1)]


def test_only_named_folders_are_read(spark, table):
    for n in range(4):
        table.merge(rows(spark, (n, "a", n), (n, f"p{n}", n)), lambda old, new: old.unionByName(new))
    out = io.StringIO()
    with redirect_stdout(out):
        table.read().where("ym = 'p2'").explain()
    assert "dynamicpruning" in out.getvalue().lower() and "ym#" in out.getvalue()
    assert held(table)[:2] == [(0, "a", 0), (0, "p0", 0)]
