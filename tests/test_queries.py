"""Every query of the catalogue against its SQL, over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from docrel.plans import catalogue

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(rows):
    def cell(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else v

    return sorted((tuple(map(cell, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, sql, name):
    df = catalogue.queries()[name](spark, str(TABLES))
    names = sorted(df.columns)
    found = sql.sql(catalogue.oracle_sql()[name])
    assert sorted(found.columns) == names
    assert plain(df.select(*[f"`{n}`" for n in names]).collect()) == plain(found.select(*[f'"{n}"' for n in names]).fetchall())
