"""Every query with SQL gives what DuckDB gives on the smallest driver tables."""

import os
from pathlib import Path

import pytest

from tidemark.queries import core, platform, problems, problems_sql  # noqa: F401

DATA = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001")
QUERIES = core.QUERIES | problems.QUERIES
ORACLES = core.ORACLES | problems_sql.ORACLES

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def db():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f if f.is_file() else f / '*.parquet'}'")
    return c


def cell(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(cell(v) for v in r) for r in df.select(*names).collect()), key=repr)
    assert sorted(x[0] for x in db.execute(f"DESCRIBE {ORACLES[name]}").fetchall()) == names
    columns = ", ".join(f'"{n}"' for n in names)
    want = sorted((tuple(cell(v) for v in r) for r in db.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()), key=repr)
    assert got == want


def test_every_query_without_sql_is_known():
    assert set(QUERIES) - set(ORACLES) == {"p2_cells", "p4_unified", "p6_runs", "seed_order_items"}
