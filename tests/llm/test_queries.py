"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest

from docforge.llm import queries as corpus

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="tables are not there")


def plain(value):
    return f"{value:.6f}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = corpus.queries()[name](spark, str(DATA))
    cursor = connection.execute(corpus.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(tuple(plain(v) for _, v in sorted(zip(columns, row, strict=True))) for row in cursor.fetchall())
    assert sorted(tuple(plain(v) for _, v in sorted(r.asDict().items())) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(corpus.queries()) - set(corpus.oracle_sql())))
def test_query_runs(spark, name):
    assert corpus.queries()[name](spark, str(DATA)).count() >= (60 if name.startswith("op2") else 200)


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(DATA))
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before
        assert docs.columns == columns or name == pipeline.STAGES[-1][0]
        before = docs.count()
    assert sorted(r.doc_id for r in pipeline.run(spark, str(DATA)).collect()) == sorted(r.doc_id for r in docs.collect())
