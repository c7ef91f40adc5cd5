import duckdb
import pytest

import __spark_entry__ as entry
from corvox.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def told(v):
    if v is None or v != v:
        return ""
    return f"{float(v):.5f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    out = registry.QUERIES[name](spark, DIR)
    rows = out.collect()
    if name not in registry.ORACLES:
        assert out.columns
        return
    got = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(out.columns)
    want = sorted(tuple(told(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall())
    assert sorted(tuple(told(r[c]) for c in sorted(names)) for r in rows) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_needs_no_session():
    """The driver reads the names of the queries before there is a session."""
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=entry.ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
