"""Every registered query against its SQL twin."""

import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, spark_result, sql_result

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, con, name):
    assert spark_result(spark, name, SF_DIR) == sql_result(con, name)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_other_queries_stay_without_a_package_of_the_training_operators():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), len(e.oracle_sql()) > 70)"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr


def test_entry(spark):
    assert entry(spark).count() > 0
