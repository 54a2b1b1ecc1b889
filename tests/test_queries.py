"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import duck_rows, spark_rows
from conftest import DATA

from siftspark.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    names, rows = spark_rows(QUERIES[name](spark, DATA))
    if name in ORACLES:
        assert (names, rows) == duck_rows(duck, ORACLES[name])
    else:
        assert rows


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
