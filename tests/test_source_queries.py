"""Tables that go through a sink and come back by a source equal what SQL makes of the given tables."""

import inspect
from pathlib import Path

import duckdb
import pytest

from lexiloom.plans import source_queries as sq

TABLES = Path("/root/testdata/sf0.001")
NAMES = [n for n, f in vars(sq).items() if inspect.isfunction(f) and f.__module__ == sq.__name__ and not n.startswith("_")]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_source_queries(spark, sql, name):
    got = getattr(sq, name)(spark, str(TABLES))
    names = sorted(got.columns)
    wanted = sql.execute(f"SELECT {', '.join(names)} FROM ({getattr(sq, name.upper())})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, wanted)) and wanted
