"""Every registered query against its SQL, on the smallest data."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from recordloom.plans import QUERIES, SQL
from tools.check_queries import TABLES, rows_of


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["field", "target", "sql_type", "is_unique"]
    got = {r.field: r.target for r in df.collect()}
    assert got["lang"] == "SQL" and got["toxic"] == "MONGO"


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_the_library_is_whole_without_the_training_data_operators():
    """With their package and the pipeline gone, the entry still imports and has all other queries."""
    code = (
        "import sys; sys.modules['recordloom.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; from recordloom.plans import QUERIES, SQL\n"
        "assert e.queries() == QUERIES and e.oracle_sql() == SQL\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, check=True, timeout=120)


@pytest.mark.parametrize("group", "s n p c r d a q j w t st".split())
def test_every_inventory_id_is_registered(group):
    highest = {"s": 10, "n": 5, "p": 9, "c": 9, "r": 5, "d": 8, "a": 10, "q": 12, "j": 6, "w": 6, "t": 11, "st": 3}[group]
    ids = {int(m[1]) for m in (re.match(rf"{group}(\d+)_", n) for n in QUERIES) if m}
    assert ids == set(range(1, highest + 1))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in res.description], res.fetchall())
