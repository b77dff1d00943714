"""Every registered query against its SQL on the second engine."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, folder, db):
    assert differences(QUERIES[name](spark, folder), db, ORACLES[name]) == ""


@pytest.mark.parametrize("name", [
    "dim_customer", "fact_order_items", "star_four_dims", "promo_effectiveness", "orders_by_region",
    "revenue_by_category", "scd2_asof_lookup", "region_two_ways", "fact_returns", "list_price_match",
    "redundant_column", "fact_payments", "fact_shipments"])
def test_query_without_broadcast(name, spark, folder, db, no_broadcast):
    assert differences(QUERIES[name](spark, folder), db, ORACLES[name]) == ""


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
