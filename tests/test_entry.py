"""Every registered query against its SQL on the smallest test tables."""

import math
import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")

@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in ("events", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def multiset(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 9)
        return value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    own = {*entry_module._ON_EVENTS, *entry_module._ON_TABLES}
    assert own <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module._session_sql()))
def test_query_matches_sql(spark, sql, name):
    df = entry_module.queries()[name](spark, str(DATA))
    relation = sql.sql(entry_module.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    ours = multiset([tuple(r) for r in df.collect()], df.columns)
    theirs = multiset(relation.fetchall(), relation.columns)
    assert ours == theirs and ours


def test_flagship(spark):
    result = entry_module.entry(spark)
    assert result.columns == list(entry_module.SONG_BY_ID)
    assert result.count() == 10


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_the_rest_imports_without_the_training_data_folders(tmp_path, pipeline_stays):
    root = Path(entry_module.__file__).resolve().parent
    gone = ["llm", "__pycache__", ".git"] + ([] if pipeline_stays else ["corpus_pipeline.py"])
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(*gone))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    own = len({*entry_module._ON_EVENTS, *entry_module._ON_TABLES})
    assert done.stdout.split() == [str(own), str(len(entry_module._session_sql()))]
