"""Every registered query with an oracle against DuckDB, on the smallest tables; the others at least run."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if isinstance(v, decimal.Decimal):
            v = float(v)
        return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows), [names[i] for i in order]


@pytest.fixture(scope="session")
def tables():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return con


@pytest.mark.parametrize("name", list(entry.catalogue.QUERIES))
def test_query(spark, tables, name):
    got = entry.queries()[name](spark, DATA)
    rows = got.collect()
    if name in ORACLES:
        want = tables.execute(ORACLES[name])
        names = [c[0] for c in want.description]
        assert canonical(rows, got.columns) == canonical(want.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_import_needs_no_session():
    """The entry can be imported, and its queries and SQL listed, before there is a session."""
    import subprocess
    import sys

    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
