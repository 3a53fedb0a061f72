"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from compare import compare

import __spark_entry__ as entry
from oracle import STATEMENTS
from orderlens.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, FOLDER, name)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_text_operators(tmp_path, pipeline):
    """The rest imports and keeps its queries in a copy without that subpackage, with or
    without the pipeline's file, and with a folder that caches left behind."""
    here = Path(__file__).resolve().parent.parent
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_*"]))
    shutil.copytree(here, tmp_path / "copy", ignore=left_out)
    (tmp_path / "copy/orderlens/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(*e.queries())"
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True
    )
    assert run.returncode == 0, run.stderr
    assert set(run.stdout.split()) == set(QUERIES)
