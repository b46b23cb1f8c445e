"""CSV files of any encoding, by splits, against Python's reader."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tillbook.operators.core import HOT_CONF
from tillbook.sources import csv_files as cf


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_by_name_and_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("store,amount\n서울,1\n", "utf-8")
    (tmp_path / "b.csv").write_text("amount,store,more\n2,부산 똠,x\n", "cp949")
    (tmp_path / "c 한글+%.csv").write_text("store,amount\n�,3\n", "utf-8")
    (tmp_path / "bom.csv").write_text("store,amount\nbom,4\n", "utf-8-sig")
    (tmp_path / "short.csv").write_text("store,amount\nx,5\ny\n\nz,\n", "utf-8")
    (tmp_path / "latin.csv").write_bytes(b"store,amount\n\xff\xfe\x80,6\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("store,amount\n")
    out = cf.scan_csv_union(spark, [str(tmp_path)], ["store", "amount", "none"], source_col="f")
    want = [("서울", "1", None), ("부산 똠", "2", None), ("�", "3", None), ("bom", "4", None), ("x", "5", None), ("y", None, None), ("z", None, None), ("ÿþ\x80", "6", None)]
    assert got(out, "store", "amount", "none") == sorted(want, key=repr)


@pytest.mark.parametrize("charset", ["utf-8", "cp949"])
def test_a_row_too_long_fails_the_job_or_leaves_its_file_out(spark, tmp_path, charset):
    (tmp_path / "ok.csv").write_text("store,amount\n서,1\n", charset)
    (tmp_path / "odd.csv").write_text("store,amount\n서,1\ny,2,\n", charset)
    with pytest.raises(Exception, match="odd.csv"):
        cf.scan_csv_union(spark, [str(tmp_path)], ["store", "amount"]).collect()
    assert got(cf.scan_csv_union(spark, [str(tmp_path)], ["store", "amount"], on_error="skip"), "store", "amount") == [("서", "1")]
    skipped = cf.skipped_csv_files(spark, [str(tmp_path)], ["store", "amount"]).collect()
    assert [os.path.basename(x.file) for x in skipped] == ["odd.csv"]


def test_a_file_in_no_encoding(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"store\n\xff\n")
    (tmp_path / "y.csv").write_text("store\ny\n")
    args = (spark, [str(tmp_path)], ["store"], ("utf-8", "cp949"))
    with pytest.raises(Exception, match="no encoding"):
        cf.scan_csv_union(*args).collect()
    assert got(cf.scan_csv_union(*args, on_error="skip"), "store") == [("y",)]
    assert got(cf.skipped_csv_files(*args), "error") == [("no encoding fits",)]


def test_a_line_is_a_function_of_how_it_begins():
    rng = random.Random(3)
    for _ in range(3000):
        line = "".join(rng.choice('",a ') for _ in range(rng.randint(0, 9)))
        for inside in (False, True):
            state = "in" if inside else "start"  # of a reader that goes character by character
            ends = 0
            for c in line:
                ends += c == "," and state != "in"
                if state == "in":
                    state = "quote" if c == '"' else "in"
                elif state == "quote":
                    state = "in" if c == '"' else "start" if c == "," else "plain"
                elif c == ",":
                    state = "start"
                else:
                    state = "in" if c == '"' and state == "start" else "plain"
            assert cf.walk(line, inside) == (ends, state == "in"), (line, inside)


@pytest.mark.parametrize("charset", ["utf-8", "cp949"])
@pytest.mark.parametrize("hot", ["2000000", "50"])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, charset, hot):
    """Splits of a few kB cut records with line feeds in quotes; hot=50 takes the running values through slices."""
    rng = random.Random(7)
    rows = [[str(i), "".join(rng.choice(['"', ",", "\n", "가", "b ", "x" * 20]) for _ in range(rng.randint(0, 6))), rng.choice(["", "t"])] for i in range(3000)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([["id", "memo", "tag"], *rows])
    (tmp_path / "one.csv").write_bytes(out.getvalue().encode(charset))
    (tmp_path / "plain.csv").write_bytes("".join(f"{x}\n" for x in ["tag,id", *(f"p,{i}" for i in range(3000, 6000))]).encode(charset))
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", HOT_CONF)}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set(HOT_CONF, hot)
        df = cf.scan_csv_union(spark, [str(tmp_path)], ["id", "memo", "tag"])
        found = got(df, "id", "memo", "tag")
        lines = cf._lines(spark, [str(tmp_path)]).where(F.col("file").endswith("one.csv"))
        assert lines.select(F.spark_partition_id()).distinct().count() > 5
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = [tuple(x or None for x in r) for r in rows] + [(str(i), None, "p") for i in range(3000, 6000)]
    assert found == sorted(want, key=repr)


def test_the_plain_files_take_sparks_reader(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("store,amount\n서울,1\n", "utf-8")
    cf.scan_csv_union(spark, [str(tmp_path)], ["store"]).explain()
    plan = capsys.readouterr().out
    assert "FileScan csv" in plan and "MapInArrow" not in plan
