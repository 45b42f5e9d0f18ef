"""Every registered query against its SQL, rows and types."""

import __spark_entry__ as entry_module
import oracle
import pytest
from gridmart.plans.registered import QUERIES
from oracle_queries import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    result = entry_module.queries()[name](spark, FOLDER)
    assert oracle.differences(result, con, entry_module.oracle_sql()[name]) == []


def test_entry_is_stable(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 10
    assert rows == entry_module.entry(spark).collect()


def test_fact_counts(spark):
    """Rows per outcome are the same as counted when the tables were first looked at."""
    counts = {r.table_name: r.n_rows for r in entry_module.queries()["table_counts"](spark, FOLDER).collect()}
    assert counts["fact_race_result"] == 4951
    assert counts["dim_race"] == 1500
    assert counts["dim_date"] == 1094
