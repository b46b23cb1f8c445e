"""Appends of unseen keys read the files that may hold them, and no others."""

import numpy as np
import pytest

from tillbook.sources import keyed_appends as ka, versions as vt


def rows(spark, ids, ym="a"):
    return spark.createDataFrame([(i, f"k{i}" if i is not None else None, ym) for i in ids], "id long, k string, ym string")


@pytest.fixture
def table(spark):
    return ka.KeyedAppends(vt.new_table(spark, rows(spark, []).schema, ["ym"]), ["id", "k"])


def ids(table):
    return sorted((r.id for r in table.table.read().collect()), key=repr)


def test_filters_have_no_false_no_and_few_false_yes():
    rng = np.random.default_rng(1)
    held, others = (rng.integers(0, 2**64, n, np.uint64) for n in (5000, 5000))
    bits = ka._filter(held)
    assert all(ka.may_hold(bits, held[i : i + 1]) for i in range(0, 5000, 50))
    assert sum(ka.may_hold(bits, others[i : i + 1]) for i in range(5000)) < 100
    assert ka.may_hold(ka._filter(held[:0]), held) is False


def test_only_unseen_keys_are_appended(spark, table):
    assert tuple(table.append(rows(spark, range(100))).first()) == (100, 0, 100)
    assert tuple(table.append(rows(spark, [*range(90, 120), None], "b")).first()) == (21, 10, 31)
    assert tuple(table.append(rows(spark, [None, 5], "c")).first()) == (0, 2, 2)
    assert tuple(table.append(rows(spark, [])).first()) == (0, 0, 0)
    assert ids(table) == sorted([*range(120), None], key=repr)


def test_files_that_cannot_hold_a_key_are_not_read(spark, table, monkeypatch):
    for n in range(6):
        table.append(rows(spark, range(100 * n, 100 * n + 100), f"m{n}"))
    assert table.candidates(rows(spark, [250, 251])).count() == 1  # the ranges of text keys meet more, the filter leaves one
    assert table.candidates(rows(spark, [-3, 99_999])).count() <= 1  # a filter may err
    spread = rows(spark, [50, 550, 10_000])
    assert 2 <= table.candidates(spread).count() <= 3
    monkeypatch.setattr(ka, "MAX_KEYS", 1)
    assert table.candidates(spread).count() >= 2
    assert tuple(table.append(spread).first()) == (1, 2, 3)


def test_files_without_an_index_are_read(spark, table):
    table.table.append(rows(spark, range(10)))  # written by other means
    assert tuple(table.append(rows(spark, [5, 11])).first()) == (1, 1, 2)
    table.table.merge(rows(spark, [5], "a"), lambda old, new: old.where("id <> 5"))
    assert tuple(table.append(rows(spark, [5, 6])).first()) == (1, 1, 2)


def test_a_lost_append_leaves_nothing_and_may_be_repeated(spark, table, monkeypatch):
    table.append(rows(spark, [1]))
    monkeypatch.setattr(table.table, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.append(rows(spark, [1, 2]))
    monkeypatch.undo()
    assert ids(table) == [1]
    assert tuple(table.append(rows(spark, [1, 2])).first()) == (1, 1, 2) and ids(table) == [1, 2]
