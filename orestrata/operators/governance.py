"""Data classes, masking, reference values, tags and lineage, all as joins and projections."""

from __future__ import annotations

from itertools import count
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.contracts import CONTRACTS, PII, tagged_columns
from orestrata.session import shared_folder


@dataclass(frozen=True)
class DataClass:
    name: str
    value_pattern: str
    column_pattern: str


# Class, pattern of its values, pattern of the column names it applies to.
DATA_CLASSES = (
    DataClass("Customer ID", r"^[0-9]{4}$", r"^customer_id$"),
    DataClass("Customer Email", r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$", r"^email$"),
    DataClass("Customer Country", r"^(US|GB|DE|FR|IT|ES|NL)$", r"^country$"),
    DataClass("Customer 360", r"^(?:0|[1-9][0-9]{0,9})(?:\.[0-9]{1,2})?$", r"^lifetime_value$"),
    DataClass("Product ID", r"^2[0-9]{3}$", r"^product_id$"),
    DataClass("Product Category", r"^(Electronics|Grocery|Home|Office|Outdoor)$", r"^(category|product_category)$"),
    DataClass("Unit Price", r"^(?:0|[1-9][0-9]{0,4})(?:\.[0-9]{1,2})?$", r"^unit_price$"),
    DataClass("Order ID", r"^3[0-9]{3}$", r"^order_id$"),
    DataClass("Order Status", r"^(completed|returned|pending|cancelled)$", r"^(status|order_status)$"),
    DataClass("Order Quantity", r"^[1-9][0-9]?$", r"^quantity$"),
    DataClass("Net Amount", r"^(?:0|[1-9][0-9]{0,9})(?:\.[0-9]{1,2})?$", r"^net_amount$"),
    DataClass("Daily Sales", r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$", r"^order_date$"),
    DataClass("Net Revenue", r"^(?:0|[1-9][0-9]{0,9})(?:\.[0-9]{1,2})?$", r"^(net_revenue|total_revenue)$"),
    DataClass("Category Performance", r"^(?:0|[1-9][0-9]{0,6})$", r"^(total_orders|order_count)$"),
)

# Controlled vocabularies and the labels of their values.
REFERENCE_SETS = {
    "order_status": {
        "completed": "Order fulfilled and paid; the only status included in net revenue and lifetime value.",
        "returned": "Order returned by the customer; excluded from revenue.",
        "pending": "Order placed but not yet fulfilled; excluded from recognised revenue.",
        "cancelled": "Order cancelled before fulfilment; excluded from revenue.",
    },
    "payment_method": {
        "card": "Credit or debit card payment.",
        "paypal": "PayPal wallet payment.",
        "bank_transfer": "Direct bank / wire transfer.",
    },
    "product_category": {
        "Electronics": "Consumer electronics and devices.",
        "Grocery": "Food and everyday grocery items.",
        "Home": "Home goods and furnishings.",
        "Office": "Office supplies and equipment.",
        "Outdoor": "Outdoor, garden and sports goods.",
    },
    "country": {
        "US": "United States",
        "GB": "United Kingdom",
        "DE": "Germany",
        "FR": "France",
        "IT": "Italy",
        "ES": "Spain",
        "NL": "Netherlands",
    },
}

# Column -> reference set its values come from.
VOCABULARY_COLUMNS = {
    "status": "order_status",
    "payment_method": "payment_method",
    "category": "product_category",
    "country": "country",
}


DETECTED = (
    "table_name string, column string, data_class string, name_matches boolean, present bigint, matched bigint, "
    "assigned boolean"
)


def class_for(column: str, classes: Sequence[DataClass] = DATA_CLASSES) -> DataClass | None:
    """The class that claims a column by its name."""
    return next((c for c in classes if re.search(c.column_pattern, column)), None)


def detect_classes(
    df: DataFrame,
    table: str,
    classes: Sequence[DataClass] = DATA_CLASSES,
    threshold: float = 0.8,
    by_value: bool = False,
) -> DataFrame:
    """How well columns fit the classes that claim them by name, in one pass over the whole table.

    (table_name, column, data_class, name_matches, present, matched, assigned): a class is assigned
    where the name fits and at least `threshold` of the non-null values do. With `by_value` every
    column is held against every class, which finds values under an unexpected name.
    """
    pairs = [
        (name, data_class, bool(re.search(data_class.column_pattern, name)))
        for name in df.columns
        for data_class in classes
    ]
    tried = [(name, c, named) for name, c, named in pairs if named or by_value]
    if not tried:
        return df.sparkSession.createDataFrame([], DETECTED)
    names = list(dict.fromkeys(name for name, _, _ in tried))
    patterns = list(dict.fromkeys(c.value_pattern for _, c, _ in tried))
    often = _often_repeated(df, names) if len(tried) > 2 * len(names) else []
    parts = []
    # Columns whose values repeat are merged to one row per value first, and each pattern is tried once per value.
    if often:
        long = _long(df, often).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(_fitting(long, tried, often, patterns))
    rest = [name for name in names if name not in often]
    if rest:
        parts.append(_fitting(_long(df, rest).withColumn("n", F.lit(1)), tried, rest, patterns))
    counts = reduce(DataFrame.unionByName, parts)
    fits = [
        F.struct(
            F.lit(name).alias("of"),
            F.lit(c.name).alias("data_class"),
            F.lit(named).alias("name_matches"),
            F.col(f"fits__{patterns.index(c.value_pattern)}").alias("matched"),
        )
        for name, c, named in tried
    ]
    enough = (F.col("present") > 0) & (F.col("matched") >= F.lit(threshold) * F.col("present"))
    return (
        counts.select("column", "present", F.explode(F.array(*fits)).alias("r"))
        .where(F.col("r.of") == F.col("column"))
        .select(F.lit(table).alias("table_name"), "column", "r.data_class", "r.name_matches", "present", "r.matched")
        .withColumn("assigned", F.col("name_matches") & enough)
    )


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(name).cast("string").alias(name) for name in names]).unpivot([], list(names), "column", "value")


# Distinct values up to which a column is merged before it is tried: what a task then shuffles stays small at any size of the table.
MERGED = 100_000


def _often_repeated(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns with few distinct values, for their rows and in all, by one scan of estimates.

    Keys of a large table have too many: hardly a value comes twice in a task, so merging would shuffle most rows.
    """
    found = df.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.col(name).cast("string"), 0.1) for name in names]).first()
    return [name for name, n in zip(names, found[1:]) if n * 8 <= found[0] and n <= MERGED]


def _fitting(values: DataFrame, tried: list, names: Sequence[str], patterns: list[str]) -> DataFrame:
    """Per column the rows with a value, and those whose value fits each pattern: merged in every task, no value is shuffled."""
    fits = []
    for i, pattern in enumerate(patterns):
        wanted = [n for n, c, _ in tried if c.value_pattern == pattern and n in names]
        hit = F.col("value").rlike(pattern)
        if set(wanted) != set(names):
            hit = F.col("column").isin(*wanted) & hit if wanted else F.lit(False)
        fits.append(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("bigint").alias(f"fits__{i}"))
    present = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint")
    return values.groupBy("column").agg(present.alias("present"), *fits)


def class_catalog(detected: DataFrame) -> DataFrame:
    """data_class -> sorted list of `table.column` it was assigned to (metadata, one entry per column)."""
    where = F.concat_ws(".", "table_name", "column")
    return (
        detected.where("assigned").groupBy("data_class").agg(F.sort_array(F.collect_list(where)).alias("columns"))
    )


def mask_columns(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Obfuscate columns; a rule is redact (letters and digits replaced), hash (SHA-256) or drop (null).

    Nulls stay null, and rules for columns the frame does not have are ignored.
    """
    actions = {
        "redact": lambda c: F.mask(c),
        "hash": lambda c: F.sha2(c, 256),
        "drop": lambda c: F.lit(None).cast("string"),
    }
    masked = {}
    for name, rule in rules.items():
        if rule not in actions:
            raise ValueError(f"unknown masking rule {rule!r}")
        if name in df.columns:
            masked[name] = actions[rule](F.col(name).cast("string"))
    return df.withColumns(masked) if masked else df


def mask_pii(df: DataFrame, rule: str = "redact") -> DataFrame:
    """Mask the columns tagged as personal data, and `email` in any frame."""
    names = dict.fromkeys([*tagged_columns(df, PII), *(["email"] if "email" in df.columns else [])])
    return mask_columns(df, {name: rule for name in names})


def reference_set(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(list(REFERENCE_SETS[name].items()), "value string, description string")


def conformance(df: DataFrame, column: str, set_name: str) -> DataFrame:
    """Values of a column, their rows, whether the reference set knows them, and their label."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    known = reference_set(df.sparkSession, set_name)
    return counts.join(known, "value", "left").select(
        F.lit(set_name).alias("reference_set"),
        "value",
        "n_records",
        F.col("description").isNotNull().alias("conforms"),
        "description",
    )


@dataclass(frozen=True)
class NameRule:
    """A label for names that contain one of `parts`, are one of `wholes` or begin with one of `starts`, and have none of `unless`."""

    label: str
    parts: tuple[str, ...] = ()
    wholes: tuple[str, ...] = ()
    starts: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()


# Labels of column names and of table names.
DOMAIN_TAGS = (
    NameRule("Customer", ("customer",), ("first_name", "last_name", "email", "country", "signup_date")),
    NameRule("Product", ("product",), ("category", "unit_price")),
    NameRule("Order", ("order",), ("status", "payment_method", "quantity", "discount_pct")),
    NameRule("FinancialMetric", ("price", "amount", "revenue", "value", "discount")),
    NameRule("PII", wholes=("email",)),
    NameRule("OperationalMetadata", wholes=("transformed_at",), starts=("_",)),
)
TABLE_TERMS = (
    NameRule("Customer", ("customer",), unless=("customer_360",)),
    NameRule("Customer360", ("customer_360",)),
    NameRule("Order", ("order", "sales")),
    NameRule("Product", ("product", "category")),
    NameRule("RevenueMetric", ("sales", "performance")),
)

# Suffix of a schema name, its layer, the layer's glossary term.
LAYERS = (
    ("_raw", "Raw", "RawLanding"),
    ("_bronze", "Bronze", "BronzeLayer"),
    ("_silver", "Silver", "SilverLayer"),
    ("_gold", "Gold", "GoldLayer"),
)


def labels_of(name: str | Column, rules: Sequence[NameRule]) -> Column:
    """Sorted labels of the rules that a name meets: one matcher over the rules as an array of rows."""
    subject = _col(name)

    def texts(values: Sequence[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    rows = F.array(
        *[
            F.struct(F.lit(r.label).alias("label"), *[texts(getattr(r, k)).alias(k) for k in ("parts", "wholes", "starts", "unless")])
            for r in rules
        ]
    )

    def met(rule: Column) -> Column:
        hit = F.exists(rule["parts"], subject.contains) | F.array_contains(rule["wholes"], subject) | F.exists(rule["starts"], subject.startswith)
        return hit & ~F.exists(rule["unless"], subject.contains)

    return F.array_sort(F.transform(F.filter(rows, met), lambda rule: rule["label"]))


def domain_tags(column: str | Column) -> Column:
    """Sorted tags of a column name."""
    return labels_of(column, DOMAIN_TAGS)


def layer_of(schema: str | Column) -> Column:
    """Layer of a schema by its suffix; Raw when none fits."""
    name = _col(schema)
    found = [F.when(name.endswith(suffix), F.lit(label)) for suffix, label, _ in LAYERS]
    return F.coalesce(*found, F.lit("Raw"))


def glossary_terms(table: str | Column, layer: str | Column) -> Column:
    """Sorted glossary terms of a table name and its layer."""
    level = _col(layer)
    of_layer = F.array_compact(F.array(*[F.when(level == label, F.lit(term)) for _, label, term in LAYERS]))
    return F.array_sort(F.array_union(of_layer, labels_of(table, TABLE_TERMS)))


def merge_tags(existing: str | Column, wanted: str | Column) -> Column:
    """Existing tags, in place, then the wanted ones that are new."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(_col(existing), none), F.coalesce(_col(wanted), none)))


def tag_columns(columns: DataFrame) -> DataFrame:
    """(schema_name, table_name, column) rows with their layer, tags and terms."""
    return columns.withColumns(
        {"layer": layer_of("schema_name"), "tags": domain_tags("column")}
    ).withColumn("terms", glossary_terms("table_name", "layer"))


def lineage_edges(spark: SparkSession) -> DataFrame:
    """(source, target) of every table the contracts declare, below the raw layer's names."""
    edges = [(source, c.name) for c in CONTRACTS.values() for source in c.feeds]
    return spark.createDataFrame(edges, "source string, target string")


def relationships(spark: SparkSession) -> DataFrame:
    """(child, child_column, parent, parent_column) of every declared reference."""
    rows = [(c.name, column, *to) for c in CONTRACTS.values() for column, to in c.references.items()]
    return spark.createDataFrame(rows, "child string, child_column string, parent string, parent_column string")


def closure(edges: DataFrame) -> DataFrame:
    """(source, target, distance): everything downstream of every node, by its shortest path.

    One join per step until nothing is new, at any depth; what is known is not reached again, so a cycle
    ends too. Every step's result is checkpointed, so the plan does not grow.
    """
    shared_folder(edges.sparkSession)  # checkpoints go there
    known = edges.select("source", "target").distinct().withColumn("distance", F.lit(1))
    frontier = known
    for step in count(2):
        reached = (
            frontier.select("source", F.col("target").alias("via"))
            .join(edges.select(F.col("source").alias("via"), "target"), "via")
            .select("source", "target")
            .distinct()
            .join(known, ["source", "target"], "left_anti")
            .withColumn("distance", F.lit(step))
            .checkpoint()
        )
        if reached.isEmpty():
            return known
        known = known.unionByName(reached)
        frontier = reached


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
