"""Deliveries are merged once, wherever the job was stopped."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest

from tillbook.session import fresh_path
from tillbook.sources import inbox as ib, versions as vt

LATER = datetime.now() + timedelta(hours=1)


def deliver(spark, root, run, parts, wrong=0, manifest=True):
    """Write the files of a run and its manifest; ``wrong`` is added to one size."""
    files = {}
    for name, rows in parts.items():
        rows.coalesce(1).write.parquet(f"{root}/tmp-{run}/{name}")
        (part,) = [f for f in os.listdir(f"{root}/tmp-{run}/{name}") if f.startswith("part-")]
        os.rename(f"{root}/tmp-{run}/{name}/{part}", f"{root}/{run}-{name}.parquet")
        files[f"{run}-{name}.parquet"] = {"rel": f"{name}/x.parquet", "size": os.path.getsize(f"{root}/{run}-{name}.parquet") + wrong}
        wrong = 0
    if manifest:
        with open(f"{root}/manifest_{run}.json", "w") as f:
            json.dump({"run": run, "files": files}, f)


@pytest.fixture
def place(spark, tmp_path):
    day = spark.createDataFrame([], "store string, ym string, v int")
    log = spark.createDataFrame([], "what string, ym string")
    tables = {"daily": vt.new_table(spark, day.schema, ["ym"]), "log": vt.new_table(spark, log.schema, ["ym"])}
    # The log is appended to, so that a delivery merged twice would show.
    datasets = {"daily": ib.Dataset(tables["daily"], ib.keyed(["store"], ["v"])), "log": ib.Dataset(tables["log"], lambda old, new: old.unionByName(new))}
    return str(tmp_path), fresh_path(spark, "ledger"), datasets


def rows(spark, *given):
    return {
        "daily": spark.createDataFrame([(s, "a", v) for s, v in given], "store string, ym string, v int"),
        "log": spark.createDataFrame([(f"{s}{v}", "a") for s, v in given], "what string, ym string"),
    }


def held(datasets):
    return sorted((r.store, r.v) for r in datasets["daily"].table.read().collect()), sorted(r.what for r in datasets["log"].table.read().collect())


def test_runs_are_merged_once_and_wait_until_they_are_whole(spark, place):
    root, ledger, datasets = place
    deliver(spark, root, "r1", rows(spark, ("x", 1), ("y", 2)))
    deliver(spark, root, "r2", rows(spark, ("y", 3)) | {"other": spark.range(1)})
    deliver(spark, root, "r3", rows(spark, ("z", 9)), wrong=5)
    deliver(spark, root, "r4", rows(spark, ("z", 9)), manifest=False)
    (open(f"{root}/manifest_bad.json", "w")).write("{no json")
    done = ib.merge_inbox(spark, root, datasets, ledger, LATER)
    assert done == [("r1", "daily", "merged"), ("r1", "log", "merged"), ("r2", "daily", "merged"), ("r2", "log", "merged"), ("r2", "other", "unknown dataset")]
    assert held(datasets) == ([("x", 1), ("y", 3)], ["x1", "y2", "y3"])
    assert ib.merge_inbox(spark, root, datasets, ledger, LATER) == []
    assert ib.merge_inbox(spark, root, datasets, ledger, datetime.now() - timedelta(hours=1)) == []


def test_a_job_that_stops_between_two_datasets_is_run_again(spark, place):
    root, ledger, datasets = place
    deliver(spark, root, "r1", rows(spark, ("x", 1)))

    def lost(spark, paths):
        raise OSError("lost")

    broken = datasets | {"log": ib.Dataset(datasets["log"].table, datasets["log"].policy, lost)}
    with pytest.raises(OSError):
        ib.merge_inbox(spark, root, broken, ledger, LATER)
    assert held(datasets) == ([("x", 1)], [])
    # The claim of the lost job holds until its lease is over.
    assert ib.merge_inbox(spark, root, datasets, ledger, LATER) == [("r1", "", "claimed")]
    assert ib.merge_inbox(spark, root, datasets, ledger, LATER, lease_minutes=0) == [("r1", "daily", "was merged"), ("r1", "log", "merged")]
    assert held(datasets) == ([("x", 1)], ["x1"])


def test_a_job_that_stops_before_the_run_is_marked_changes_nothing_when_run_again(spark, place, monkeypatch):
    root, ledger, datasets = place
    deliver(spark, root, "r1", rows(spark, ("x", 1)))
    monkeypatch.setattr(ib.Ledger, "finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ib.merge_inbox(spark, root, datasets, ledger, LATER)
    monkeypatch.undo()
    time.sleep(0.01)
    assert {what for *_, what in ib.merge_inbox(spark, root, datasets, ledger, LATER, lease_minutes=0)} == {"was merged"}
    assert held(datasets) == ([("x", 1)], ["x1"])


def test_only_one_job_claims_a_run(spark):
    book = ib.Ledger(spark, fresh_path(spark, "ledger"))
    assert book.claim("a run/1") and not book.claim("a run/1") and book.claim("a run_1")
    book.finish("a run/1")
    assert book.finished("a run/1") and not book.finished("a run_1")
