"""Every registered document query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from docforge import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="tables are not there")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "-"
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return str(value)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_sql(spark, sql, name):
    df = catalog.queries()[name](spark, str(DATA))
    cursor = sql.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(plain(v) for v in dict(sorted(zip(columns, row, strict=True))).values()) for row in cursor.fetchall())
    have = sorted(tuple(plain(v) for v in dict(sorted(r.asDict().items())).values()) for r in df.collect())
    assert have == want


def test_flagship(spark):
    assert catalog.flagship(spark, str(DATA)).count() == 16


def test_registry_without_the_corpus_operators():
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
