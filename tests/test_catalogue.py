"""Every query of the evidence and inventory operators gives what its SQL gives; those without SQL give stable schemas."""

from __future__ import annotations

import pytest

from conftest import canonical_rows
from sparrowgrid.plans.catalogue import ORACLE, QUERIES


def test_oracles_belong_to_queries():
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, data, name):
    ours, theirs = QUERIES[name](spark, data).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical_rows(ours) == canonical_rows(theirs)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE.keys()))
def test_query_without_sql_runs(spark, data, name):
    assert QUERIES[name](spark, data).toPandas().shape[1] > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 375
