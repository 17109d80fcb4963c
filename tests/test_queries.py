"""Every registered query against its SQL, and the entry point."""

import pytest

import __spark_entry__ as entry
from bindings.queries import QUERIES
from tests.conftest import SF
from tools.compare import compare


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fraud_score" in df.columns


def test_result_does_not_depend_on_the_session_time_zone(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, duck, SF, "region_monitor_stream") == ""
        assert compare(spark, duck, SF, "kpi_summary") == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
