"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, open_tables
from tidemark.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    return open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_without_the_subpackage(tmp_path):
    """Everything else imports where the operators for training text are absent."""
    root = Path(__file__).resolve().parents[1]
    leave = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "tidemark", tmp_path / "tidemark", ignore=leave)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
    assert run.stdout.split() == [str(len(QUERIES)), "False", "False"]


def test_entry(spark):
    assert entry(spark).columns == ["feature_name", "total_uses", "unique_users"]
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    assert difference(df, df.collect(), duck, oracle_sql()[name]) is None
