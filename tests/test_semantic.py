"""Metric queries and their validation."""

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from shop import entities, rows

from orestrata.operators import semantic
from orestrata.plans import medallion


@pytest.fixture(scope="module")
def fact(spark):
    return medallion.to_fact(medallion.to_silver(entities(spark)))


@pytest.fixture(scope="module")
def daily(spark, fact):
    return medallion.to_marts(fact, medallion.to_silver(entities(spark)).customers)["daily_sales"]


def test_by_month(daily):
    found = semantic.metric_query(semantic.DAILY_SALES, daily, ["total_net_revenue", "total_orders"], ["order_date__month"])
    assert rows(found) == [
        (date(2026, 1, 1), Decimal("204.04"), 3),
        (date(2026, 2, 1), Decimal("95.01"), 1),
    ]


def test_all_statuses_at_line_grain(fact):
    found = semantic.metric_query(semantic.SALES_ORDERS, fact, ["order_line_count", "units_sold", "gross_revenue"], ["status"])
    assert rows(found) == [
        ("cancelled", 1, 1, Decimal("3.99")),
        ("completed", 4, 5, Decimal("304.52")),
        ("pending", 1, 2, Decimal("7.98")),
        ("returned", 1, 5, Decimal("19.95")),
    ]
    total = semantic.metric_query(semantic.SALES_ORDERS, fact, ["net_revenue"], where="status = 'completed'")
    assert rows(total) == [(Decimal("299.05"),)]


def test_entity_keys(daily):
    keyed = semantic.with_entity_keys(semantic.DAILY_SALES, daily)
    assert rows(keyed, "daily_sales_key")[0] == ("2026-01-02|Grocery",)


def test_unknown_names(daily):
    for metrics, dims in ([["nope"], []], [["total_orders"], ["nope"]], [["total_orders"], ["category__month"]], [["total_orders"], ["order_date__hour"]]):
        with pytest.raises(ValueError):
            semantic.metric_query(semantic.DAILY_SALES, daily, metrics, dims)


def test_validation(daily, fact):
    assert semantic.validate(semantic.DAILY_SALES, daily) == []
    assert semantic.validate(semantic.SALES_ORDERS, fact) == []
    broken = replace(
        semantic.DAILY_SALES,
        time_dimension="category",
        dimensions=(semantic.Dimension("category"), semantic.Dimension("day", "hour")),
        measures=(semantic.Measure("m", "median", "nothing"),),
    )
    assert len(semantic.validate(broken, daily)) == 5
    with pytest.raises(ValueError, match="median"):
        semantic.metric_query(broken, daily, ["m"])


def test_finer_grain_is_refused(daily):
    monthly = replace(semantic.DAILY_SALES, dimensions=(semantic.Dimension("order_date", "month"), semantic.Dimension("category")))
    with pytest.raises(ValueError, match="finer"):
        semantic.metric_query(monthly, daily, ["total_orders"], ["order_date__day"])
