"""Every query that SQL can express, against its SQL on the given tables."""

import pytest

from llm_checks import TESTDATA, check_against_sql
from couriermart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, tables, name):
    check_against_sql(QUERIES[name](spark, f"{TESTDATA}/sf0.01"), ORACLES[name], tables)
