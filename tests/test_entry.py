"""Every registered query beside its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "rank", "paper_id", "similarity"]


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    good, note = compare(spark, FOLDER, queries()[name], oracle_sql()[name])
    assert good, note
