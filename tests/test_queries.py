"""Every registered query of the engine against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from perigee.plans.catalog import oracles, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return int(value) if isinstance(value, bool) else value


def test_all_oracles_belong_to_queries():
    assert set(oracles()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query(spark, database, name):
    found = queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = database.sql(oracles()[name])
    assert sorted(expected.columns) == columns
    show = lambda rows, names: sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in rows)
    ours = [[float(v) if type(v).__name__ == "Decimal" else v for v in r] for r in found.collect()]
    theirs = [[float(v) if type(v).__name__ == "Decimal" else v for v in r] for r in expected.fetchall()]
    level = lambda rows: [r.replace(".0,", ",").replace(".0]", "]") for r in rows]
    assert level(show(ours, found.columns)) == level(show(theirs, expected.columns))
