"""Every core query runs, and equals its SQL where there is one."""

import datetime
import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from folioloom.plans import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents books authors chapters zh_chapters zh_sources gutendex_authors raw_bodies difficulty_results subject_areas subject_labels mix_targets"
).split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="session")
def duck(small):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, small, duck, name):
    df = registry.QUERIES[name](spark, small)
    got = df.collect()
    if name not in registry.SQL:
        assert df.columns
        return
    cursor = duck.execute(registry.SQL[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in got), key=repr)
    theirs = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in cursor.fetchall()), key=repr)
    assert ours == theirs


def test_entry_imports_without_the_llm_folder(tmp_path):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "folioloom", tmp_path / "folioloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p7_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(registry.QUERIES)
