"""The queries that SQL can express, against DuckDB; every query over awkward tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from llm import edge
from oracle_check import norm, table_rows
from tillbook.llm import queries

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(queries.ORACLE)


def same(spark, folder, name, files):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{files}')")
    df = queries.QUERIES[name](spark, folder)
    cols, got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(queries.ORACLE[name])
    want_cols, want = table_rows([d[0] for d in cur.description], cur.fetchall())
    assert cols == want_cols
    assert got == want


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, name):
    same(spark, SF, name, "")


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return edge.write(spark, tmp_path_factory.mktemp("awkward"))


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql_on_awkward_rows(spark, awkward, name):
    same(spark, awkward, name, "/*.parquet")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables_give_empty_results(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, edge.write(spark, tmp_path / "t", empty=True)).collect() == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op5_suffix_array_dedup", "op11_phrase_collocations"}))
def test_one_row_each_and_extra_columns(spark, awkward, tmp_path, name):
    key, rows = ("page_id", edge.PAGES) if name.startswith(("op1_", "op6_")) else ("doc_id", edge.TEXTS)
    plain = queries.QUERIES[name](spark, awkward)
    wide = queries.QUERIES[name](spark, edge.write(spark, tmp_path / "t", extra=True))
    ids = sorted((norm(r[key]) for r in plain.select(key).collect()))
    assert ids == sorted(norm(r[0]) for r in rows)
    assert wide.schema == plain.schema and wide.count() == len(rows)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    folder = edge.write(spark, tmp_path / "t", extra=True)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.columns[-2:] == ["shard_", "slot_"]
    empty = edge.write(spark, tmp_path / "e", empty=True)
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_registered(spark):
    assert len([q for q in entry.queries() if q.startswith("op")]) >= 10 and "pipeline" in entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
