"""Every query against its SQL twin."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from gaugeflow.plans import catalog, oracles

QUERIES = contract.queries()
ORACLES = oracles.oracle_sql()


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(QUERIES)
    assert set(catalog.QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    twin = compare.connect(sf_dir).execute(ORACLES[name])
    assert compare.differences(result, twin)[:3] == []


def test_trained_coefficients(spark, sf_dir):
    rows = QUERIES["lr_coefficients"](spark, sf_dir).collect()
    values = {row.feature: row.coefficient for row in rows}
    assert len(values) == 19
    # Of the categories, cat0 and cat4 say most about the label; cat0 = 1 is bad.
    assert values["cat0"] < -0.5 and values["cat4"] > 0.5


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.count() == 1000
    assert set(result.columns) == {
        "key", "label", "margin", "probability", "prediction", "status",
    }
