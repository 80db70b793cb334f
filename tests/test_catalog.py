"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import subprocess
import sys

import pytest
from compare import connect, duckdb_result, spark_result

import __spark_entry__ as contract
from rowloom.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
QUERIES = {key: run for key, run in contract.queries().items() if key in catalog.QUERIES}
ORACLE = {key: sql for key, sql in contract.oracle_sql().items() if key in catalog.QUERIES}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_result(spark, database, key):
    df = QUERIES[key](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ours = spark_result(df)
    theirs = duckdb_result(database, ORACLE[key])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "c_custkey" and df.count() == 150


@pytest.mark.parametrize("absent", ["rowloom.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "regex"])
def test_core_stands_without_the_text_operators(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(catalog.QUERIES))] * 2
