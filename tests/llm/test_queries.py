"""The queries with SQL against it, all queries' contracts, and the pipeline."""

import os

import pytest

import corpus_pipeline
from layerforge.llm import queries as llm
from layerforge.llm.storage import written

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_matches_sql(name, spark, sf_dir, db):
    df = llm.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = db.execute(f"SELECT {', '.join(columns)} FROM ({llm.oracle_sql()[name]})")
    want = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries() if n.startswith("op")) == list(range(1, 14))


def test_stages_keep_columns_and_only_take_rows_away(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir), name)
        assert kept.columns == docs.columns and kept.schema == docs.schema
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert ids < before and len(ids) > 0.8 * len(before)
        docs, before = kept, ids
    pieces = corpus_pipeline.pack(spark, docs, sf_dir)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == before
