"""Every registered query against its SQL, on the smallest driver tables."""

import pytest

from surestar.queries import ALL
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, name):
    assert ALL[name].sql, "every query has SQL to compare with"
    assert compare(spark, FOLDER, ALL[name]) == []


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0
