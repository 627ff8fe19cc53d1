"""Every query with SQL gives DuckDB's rows; the others give rows."""

import decimal
import math

import duckdb
import pytest

from folioflow import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted("|".join(map(plain, r)) for r in df.select(*columns).collect())
    sql = catalog.oracle_sql().get(name)
    if sql is not None:
        found = duck.sql(sql)
        assert sorted(found.columns) == columns
        assert rows == sorted("|".join(map(plain, r)) for r in found.project(",".join(f'"{c}"' for c in columns)).fetchall())
