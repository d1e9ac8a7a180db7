"""Every query of the catalog against its check SQL on the smallest tables."""

import __spark_entry__ as entry
import pytest
from check import compare

from panelmill.catalog import CHECKS, QUERIES

from .conftest import SF


def test_registry():
    assert set(CHECKS) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country_name", "country_code", "electricity_change_pp", "life_expectancy_change_years"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], CHECKS[name]) is None
