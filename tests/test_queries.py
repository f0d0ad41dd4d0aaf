import os
import subprocess
import sys

import pytest
from compare import both
from tickbars.plans.oracle import ORACLE_SQL
from tickbars.plans.registry import QUERIES

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_works_without_the_optional_operators():
    """As if tickbars/llm and the pipeline were not there."""
    code = "import sys; sys.modules['corpus_pipeline'] = sys.modules['tickbars.llm'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES))"
    root = os.path.dirname(entry.__file__)
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "True", out.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    our_columns, ours, their_columns, theirs = both(spark, name, FOLDER)
    assert our_columns == their_columns
    assert ours == theirs
    assert ours


def test_entry(spark):
    frame = entry.entry(spark)
    assert "sma_value" in frame.columns
    assert frame.count() > 0
