"""Registered queries against their SQL at the smallest size."""

import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tickloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, db, name):
    df, rel = catalog.queries()[name](spark, SF), db.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    place = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    want = sorted((tuple(plain(r[k]) for k in place) for r in rel.fetchall()), key=str)
    assert got == want


def test_every_telemetry_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "period_ns" in df.columns


def test_entry_imports_without_the_corpus_operators(tmp_path):
    """The entry and the telemetry queries need neither the subpackage nor the pipeline."""
    import shutil
    import subprocess
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
