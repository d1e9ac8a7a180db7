"""Registered queries of this package, against their SQL where there is one."""

import __spark_entry__ as entry
import pytest
from check import compare

from panelmill.llm.queries import CHECKS, QUERIES

from ..conftest import SF


def test_registry():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(CHECKS))
def test_query(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], CHECKS[name]) is None
