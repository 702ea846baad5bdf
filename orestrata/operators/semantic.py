"""A small metric layer: declared dimensions and measures, compiled to one grouping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.times import GRAINS, at_grain

AGGREGATIONS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


@dataclass(frozen=True)
class Dimension:
    name: str
    grain: str | None = None  # set for time dimensions

    @property
    def is_time(self) -> bool:
        return self.grain is not None


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str


@dataclass(frozen=True)
class Entity:
    name: str
    kind: str  # primary or foreign
    expr: str


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    time_dimension: str
    entities: tuple[Entity, ...]
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]

    def dimension(self, name: str) -> Dimension:
        return _named(self.dimensions, name, "dimension")

    def measure(self, name: str) -> Measure:
        return _named(self.measures, name, "measure")


DAILY_SALES = SemanticModel(
    name="daily_sales",
    table="gold_daily_sales",
    time_dimension="order_date",
    entities=(Entity("daily_sales_key", "primary", "cast(order_date as string) || '|' || category"),),
    dimensions=(Dimension("order_date", "day"), Dimension("category")),
    measures=(
        # Adds up counts per day and category: an order in two categories counts twice, by contract.
        Measure("total_orders", "sum", "order_count"),
        Measure("total_units_sold", "sum", "units_sold"),
        Measure("total_net_revenue", "sum", "net_revenue"),
    ),
)

# Order lines of all statuses.
SALES_ORDERS = SemanticModel(
    name="sales_orders",
    table="silver_sales_enriched",
    time_dimension="order_date",
    entities=(
        Entity("order_item_id", "primary", "order_item_id"),
        Entity("order_id", "foreign", "order_id"),
        Entity("customer_id", "foreign", "customer_id"),
        Entity("product_id", "foreign", "product_id"),
    ),
    dimensions=(
        Dimension("order_date", "day"),
        Dimension("category"),
        Dimension("customer_country"),
        Dimension("payment_method"),
        Dimension("status"),
    ),
    measures=(
        Measure("order_line_count", "count", "1"),
        Measure("gross_revenue", "sum", "gross_amount"),
        Measure("net_revenue", "sum", "net_amount"),
        Measure("units_sold", "sum", "quantity"),
    ),
)


def validate(model: SemanticModel, df: DataFrame) -> list[str]:
    """Problems of a model against its table: unknown expressions, aggregations, grains."""
    problems = []
    for kind, items in (("entity", model.entities), ("measure", model.measures)):
        for item in items:
            if not _resolves(df, item.expr):
                problems.append(f"{kind} {item.name}: {item.expr!r} does not resolve")
    for measure in model.measures:
        if measure.agg not in AGGREGATIONS:
            problems.append(f"measure {measure.name}: unknown aggregation {measure.agg!r}")
    for dimension in model.dimensions:
        if dimension.name not in df.columns:
            problems.append(f"dimension {dimension.name}: no such column")
        if dimension.is_time and dimension.grain not in GRAINS:
            problems.append(f"dimension {dimension.name}: unknown grain {dimension.grain!r}")
    if model.time_dimension not in [d.name for d in model.dimensions if d.is_time]:
        problems.append(f"time dimension {model.time_dimension}: not a time dimension of the model")
    return problems


def metric_query(
    model: SemanticModel,
    df: DataFrame,
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    where: str | Column | None = None,
) -> DataFrame:
    """Metrics by dimensions; a time dimension takes a grain as `order_date__month`."""
    problems = validate(model, df)
    if problems:
        raise ValueError("; ".join(problems))
    rows = df if where is None else df.where(where)
    keys = [_group(model, item).alias(item) for item in group_by]
    values = [
        AGGREGATIONS[m.agg](F.expr(m.expr)).alias(m.name) for m in (model.measure(name) for name in metrics)
    ]
    return rows.groupBy(*keys).agg(*values)


def with_entity_keys(model: SemanticModel, df: DataFrame) -> DataFrame:
    """The table with the model's computed entity keys."""
    computed = {e.name: F.expr(e.expr) for e in model.entities if e.name not in df.columns}
    return df.withColumns(computed) if computed else df


def _group(model: SemanticModel, item: str) -> Column:
    name, _, grain = item.partition("__")
    dimension = model.dimension(name)
    if not grain:
        return F.col(name)
    if not dimension.is_time:
        raise ValueError(f"dimension {name} has no time grain")
    if GRAINS.index(grain) < GRAINS.index(dimension.grain):
        raise ValueError(f"grain {grain} is finer than {dimension.grain}")
    return at_grain(name, grain)


def _named(items: tuple, name: str, kind: str):
    for item in items:
        if item.name == name:
            return item
    raise ValueError(f"unknown {kind} {name!r}, expected one of {[i.name for i in items]}")


def _resolves(df: DataFrame, expression: str) -> bool:
    try:
        df.selectExpr(expression).schema
    except Exception:  # analysis errors differ between Spark versions
        return False
    return True
