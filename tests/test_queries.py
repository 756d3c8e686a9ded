"""Registered queries against DuckDB over the smallest driver tables, where they are there."""

import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def names():
    import mnesis.plans.catalog_epochs
    import mnesis.plans.catalog_events
    import mnesis.plans.catalog_files
    import mnesis.plans.catalog_reports
    import mnesis.plans.catalog_shared
    import mnesis.plans.catalog_user  # noqa: F401  registers its queries, and those of the module that it takes adapters from
    from mnesis.plans import catalog

    return sorted(catalog.ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", names())
def test_query_agrees_with_sql(spark, duck, name):
    from mnesis.plans import catalog

    df = catalog.QUERIES[name](spark, DATA)
    rel = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted("|".join(plain(v) for v in row) for row in rel.fetchall())
    assert sorted("|".join(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
