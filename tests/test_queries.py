"""Every registered query of the library against its SQL in DuckDB, on the smallest tables and on sf0.01."""

import os

import duckdb
import pytest

from quillmine.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows(df, cols):
    def plain(v):
        if v is None or v != v:
            return None
        return float(v) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(repr(tuple(map(plain, r))) for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), connection(sf_dir).execute(ORACLES[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())


def test_rest_works_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for f in ("__spark_entry__.py",):
        shutil.copy(root / f, tmp_path / f)
    shutil.copytree(root / "quillmine", tmp_path / "quillmine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'op1_pii' in e.queries())"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr
