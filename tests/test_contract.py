"""The driver contract: every query with SQL gives the same rows, and all works without the llm subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parents[1]
CORE = [m for m in contract.PLANS]


def core_queries():
    import importlib

    return sorted(q for m in CORE for q in importlib.import_module(m).ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", core_queries())
def test_query(spark, con, name):
    df = contract.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert sorted(names) == columns and got == want


def test_without_llm(tmp_path):
    """A copy of the repository without the subpackage still has the core queries."""
    import shutil

    shutil.copytree(ROOT / "paperlake", tmp_path / "paperlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'out_extract' in q and not any(n.startswith('p2') for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "HOME": "/root"})
    assert done.returncode == 0, done.stderr
