"""Every query with SQL gives the rows of its SQL; the others give rows."""

import oracle
import pytest
from conftest import SMALL

from riskflow.plans.oracle import ORACLE_SQL
from riskflow.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    assert oracle.compare(spark, name, QUERIES[name], ORACLE_SQL[name], SMALL) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1000
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
