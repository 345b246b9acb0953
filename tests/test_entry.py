"""Registered queries against their SQL on the smallest tables, and independence from the optional subpackage."""

import datetime
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CORE = [k for k in entry.oracle_sql() if not (k[0] == "p" and k[1].isdigit() and k.split("_")[0] not in ("p2", "p4"))]


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return v.isoformat() if isinstance(v, datetime.datetime) else repr(v)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view \"{f.removesuffix('.parquet')}\" as select * from '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(entry.oracle_sql()[name])
    cols, shown = sorted(df.columns), [d[0] for d in cur.description]
    assert sorted(shown) == cols
    want = sorted(tuple(norm(r[shown.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    if os.path.isdir(FOLDER):
        assert entry.entry(spark).count() > 0


def test_runs_without_the_optional_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'p2_found' in q, 'p1_found' in q)"], cwd=tmp_path / "r", capture_output=True, text=True, check=True)
    assert out.stdout.split()[1:] == ["True", "False"]
