"""The registered queries once more, as SQL over the same test tables."""

from __future__ import annotations

from orestrata import contracts
from orestrata.operators.governance import DATA_CLASSES, DOMAIN_TAGS, REFERENCE_SETS, VOCABULARY_COLUMNS, class_for
from orestrata.operators.gold import STATUSES
from orestrata.operators.quality import AcceptedValues, NotNull, Relationship, Unique
from orestrata.plans.medallion import TESTS

_BASE = r"""
WITH RECURSIVE raw_customers AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         ' ' || split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_acctbal >= 0
              THEN ' ' || replace(c_name, '#', '.') || '@' || c_mktsegment || '.Example ' END AS email,
         CAST(CAST(DATE '1990-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INTEGER) AS DATE) AS VARCHAR) AS signup_date,
         ' ' || lower(n_name) || ' ' AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS unit_price FROM part),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
         CASE WHEN o_orderstatus = 'F' THEN ' Completed ' WHEN o_orderstatus = 'P' THEN 'Returned'
              WHEN o_orderpriority = '5-LOW' THEN 'CANCELLED' ELSE 'pending' END AS status,
         ' ' || o_orderpriority AS payment_method
  FROM orders),
raw_order_items AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE)) AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity, l_discount AS discount_pct
  FROM lineitem),
silver_customers AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email,
         CAST(signup_date AS DATE) AS signup_date, upper(trim(country)) AS country
  FROM raw_customers WHERE email IS NOT NULL),
silver_products AS (
  SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
         CAST(unit_price AS DECIMAL(12,2)) AS unit_price
  FROM raw_products WHERE product_id IS NOT NULL),
silver_orders AS (
  SELECT order_id, customer_id, order_ts, CAST(order_ts AS DATE) AS order_date, lower(trim(status)) AS status,
         lower(trim(payment_method)) AS payment_method
  FROM raw_orders WHERE order_id IS NOT NULL),
silver_order_items AS (
  SELECT order_item_id, order_id, product_id, CAST(quantity AS INTEGER) AS quantity,
         CAST(discount_pct AS DECIMAL(5,2)) AS discount_pct
  FROM raw_order_items WHERE quantity > 0),
line_cents AS (
  SELECT i.*, product_name, category, unit_price, quantity * price_cents AS gross_cents,
         (quantity * price_cents * (100 - CAST(discount_pct * 100 AS BIGINT)) + 50) // 100 AS net_cents
  FROM silver_order_items i, (SELECT *, CAST(unit_price * 100 AS BIGINT) AS price_cents FROM silver_products) p
  WHERE i.product_id = p.product_id),
placed_orders AS (
  SELECT o.*, (SELECT country FROM silver_customers c WHERE c.customer_id = o.customer_id) AS customer_country
  FROM silver_orders o WHERE customer_id IN (SELECT customer_id FROM silver_customers)),
silver_sales_enriched AS (
  SELECT order_item_id, l.order_id, order_date, order_ts, status, payment_method, customer_id, customer_country,
         product_id, product_name, category, quantity, unit_price, discount_pct,
         CAST(gross_cents * 0.01 AS DECIMAL(14,2)) AS gross_amount, CAST(net_cents * 0.01 AS DECIMAL(14,2)) AS net_amount
  FROM line_cents l, placed_orders o WHERE o.order_id = l.order_id),
order_parts AS (
  SELECT order_id, category, sum(quantity) AS units, sum(net_cents) AS cents FROM line_cents GROUP BY order_id, category),
done_parts AS (
  SELECT order_date, order_parts.* FROM order_parts, placed_orders o
  WHERE o.order_id = order_parts.order_id AND o.status = 'completed'),
gold_daily_sales AS (
  SELECT order_date, category, count(*) AS order_count, CAST(sum(units) AS BIGINT) AS units_sold,
         CAST(sum(cents) * 0.01 AS DECIMAL(24,2)) AS net_revenue
  FROM done_parts GROUP BY order_date, category),
gold_category_performance AS (
  SELECT category, count(*) AS total_orders, CAST(sum(units) AS BIGINT) AS total_units,
         CAST(sum(cents) * 0.01 AS DECIMAL(24,2)) AS total_revenue,
         CAST((2 * sum(cents) + sum(units)) // (2 * sum(units)) * 0.01 AS DECIMAL(14,2)) AS avg_revenue_per_unit
  FROM done_parts GROUP BY category),
sold_orders AS (
  SELECT *, (SELECT sum(cents) FROM order_parts p WHERE p.order_id = o.order_id) AS cents
  FROM placed_orders o WHERE order_id IN (SELECT order_id FROM order_parts) @ORDERS_SINCE@),
order_counts AS (
  SELECT customer_id, status, count(*) AS n, sum(cents) AS cents, max(order_ts) AS last_ts FROM sold_orders GROUP BY ALL),
customer_metrics AS (
  SELECT customer_id, map_from_entries(list((status, n))) AS orders, max(last_ts) AS last_activity_ts,
         sum(cents * (status = 'completed')::INTEGER) AS cents, arg_max(last_ts, status = 'completed') AS newest,
         bool_or(status = 'completed') AS has_completed
  FROM order_counts GROUP BY customer_id),
gold_customer_360 AS (
  SELECT c.*, @STATUS_COUNTS@, CAST(coalesce(cents, 0) * 0.01 AS DECIMAL(24,2)) AS lifetime_value,
         CASE WHEN has_completed THEN newest END AS last_completed_order_ts, last_activity_ts
  FROM silver_customers c LEFT JOIN customer_metrics m ON m.customer_id = c.customer_id),
raw_parts AS (
  SELECT i.order_id, category, sum(CAST(quantity AS BIGINT)) AS units,
         sum(CAST(quantity AS BIGINT) * CAST(round(unit_price * 100) AS BIGINT)) AS cents
  FROM raw_order_items i, raw_products p WHERE p.product_id = i.product_id GROUP BY i.order_id, category),
daily_gross AS (
  SELECT CAST(order_ts AS DATE) AS order_date, category, count(*) AS order_count, CAST(sum(units) AS BIGINT) AS units_sold,
         CAST(sum(cents) * 0.01 AS DECIMAL(24,2)) AS gross_revenue
  FROM raw_parts, raw_orders o WHERE o.order_id = raw_parts.order_id AND regexp_matches(status, '^ *[Cc]ompleted *$')
  GROUP BY 1, 2),
calendar AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM (SELECT CAST(min(order_date) AS TIMESTAMP) AS lo, CAST(max(order_date) AS TIMESTAMP) AS hi FROM silver_orders)),
time_spine_daily AS (SELECT date_day FROM calendar)
"""


def _sql(select: str, *ctes: str, since: str = "") -> str:
    counts = ", ".join(f"coalesce(m.orders['{status}'], 0) AS {status}_orders" for status in STATUSES)
    base = _BASE.replace("@ORDERS_SINCE@", since).replace("@STATUS_COUNTS@", counts).strip()
    return ",\n".join([base, *ctes]) + "\n" + select


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _bronze(entity: str) -> str:
    return _sql(
        f"SELECT *, 'batch load' AS _ingested_by, 'raw_{entity}.csv' AS _source_file, "
        f"'demo_seed_batch' AS _ingest_batch_id, true AS is_stamped FROM raw_{entity}"
    )


_COLUMNS = {
    "silver_customers": ["customer_id", "first_name", "last_name", "email", "signup_date", "country"],
    "silver_products": ["product_id", "product_name", "category", "unit_price"],
    "silver_orders": ["order_id", "customer_id", "order_ts", "order_date", "status", "payment_method"],
    "silver_order_items": ["order_item_id", "order_id", "product_id", "quantity", "discount_pct"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "pages": ["page_id", "url", "html"],
}
_SCORED = ["silver_customers", "silver_products", "silver_orders", "silver_order_items"]
_TYPES = {
    "signup_date": "DATE",
    "order_date": "DATE",
    "quantity": "INT",
    "unit_price": "DECIMAL",
    "discount_pct": "DECIMAL",
    "order_ts": "UNKNOWN",  # a timestamp without zone is not in the list of catalog types
    **{
        name: "BIGINT"
        for name in ("customer_id", "product_id", "order_id", "doc_id", "n_chars", "conv_id", "turn", "page_id")
    },
}


def _type_of(column: str) -> str:
    # Spark calls its text type "string", which the list of catalog types does not hold either.
    return _TYPES.get(column, "UNKNOWN")


_PROFILES = "profiles AS (" + _union(
    [
        f"SELECT '{table}' AS table_name, '{c}' AS \"column\", '{_type_of(c)}' AS data_type, count(*) AS records, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, count(DISTINCT {c}) AS distinct_count FROM {table}"
        for table, columns in _COLUMNS.items()
        for c in columns
    ]
) + ")"


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _mean(column: str, per: int) -> str:
    """Mean of a decimal(_, 2) column, rounded half up to 1/per, in whole numbers."""
    total, n = f"CAST(sum({column}) * 100 AS HUGEINT)", f"count({column})"
    unit = 100 // per
    step = {100: "0.01", 10: "0.1"}[per]
    return f"CASE WHEN {n} > 0 THEN (2 * {total} + {n} * {unit}) // (2 * {n} * {unit}) * {step} END"


_DIMENSIONS = ["completeness", "validity", "consistency", "uniqueness"]


def _row_mean(names: list[str]) -> str:
    total = " + ".join(f"coalesce(CAST({n} * 100 AS BIGINT), 0)" for n in names)
    n = " + ".join(f"CASE WHEN {x} IS NULL THEN 0 ELSE 1 END" for x in names)
    return f"CAST((2 * ({total}) + ({n})) // (2 * nullif({n}, 0)) * 0.01 AS DECIMAL(5,2))"


def _scores() -> str:
    parts = []
    for table in _SCORED:
        keys = contracts.CONTRACTS[table].key
        for c in _COLUMNS[table]:
            data_class, vocabulary = class_for(c), VOCABULARY_COLUMNS.get(c)
            text = f"CAST({c} AS VARCHAR)"
            valid = (
                f"count(*) FILTER (WHERE regexp_matches({text}, '{data_class.value_pattern}'))" if data_class else None
            )
            known = f"count(*) FILTER (WHERE {text} IN ({_quoted(REFERENCE_SETS[vocabulary])}))" if vocabulary else None
            unique = f"count(DISTINCT {c})" if c in keys else None

            def percent(part: str | None, whole: str) -> str:
                if part is None:
                    return "CAST(NULL AS DECIMAL(5,2))"
                return f"CAST({part} * 100 / nullif({whole}, 0) AS DECIMAL(5,2))"

            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS \"column\", count(*) AS records, "
                f"{percent(f'count({c})', 'count(*)')} AS completeness, {percent(valid, f'count({c})')} AS validity, "
                f"{percent(known, f'count({c})')} AS consistency, {percent(unique, f'count({c})')} AS uniqueness "
                f"FROM {table}"
            )
    return (
        "measured AS (" + _union(parts) + f"),\nscores AS (SELECT *, {_row_mean(_DIMENSIONS)} AS quality FROM measured)"
    )


_SCORECARD = (
    'cards AS (SELECT table_name, max(records) AS records, count(*) AS "columns", '
    + ", ".join(f"CAST({_mean(n, 100)} AS DECIMAL(5,2)) AS {n}" for n in _DIMENSIONS)
    + f", CAST({_mean('quality', 10)} AS DECIMAL(4,1)) AS col_avg FROM scores GROUP BY table_name),\n"
    + f"scorecard AS (SELECT *, {_row_mean(_DIMENSIONS)} AS overall FROM cards)"
)


_CLASSIFIED = [*_SCORED, "silver_sales_enriched", "gold_daily_sales", "gold_category_performance", "gold_customer_360"]


def _detected(threshold: float) -> str:
    parts = []
    for table in _CLASSIFIED:
        names = _COLUMNS.get(table) or [n for n in contracts.CONTRACTS[table].schema.names if n != "transformed_at"]
        tried = [
            f"{{'column': '{c}', 'data_class': '{k.name}', 'name_matches': {'true' if class_for(c, (k,)) else 'false'}, "
            f"'present': count({c}), 'matched': count(*) FILTER (WHERE regexp_matches(CAST({c} AS VARCHAR), '{k.value_pattern}'))}}"
            for c in names
            for k in DATA_CLASSES
        ]
        parts.append(f"SELECT '{table}' AS table_name, unnest([{', '.join(tried)}], recursive := true) FROM {table}")
    return (
        "fits AS (" + _union(parts) + "),\ndetected AS (SELECT *, name_matches AND present > 0 AND "
        f"matched >= {threshold} * present AS assigned FROM fits)"
    )


def _test_rows() -> str:
    parts = []
    for test in TESTS:
        match test:
            case NotNull():
                kind, failing = "not_null", f"(SELECT count(*) FROM {test.table} WHERE {test.column} IS NULL)"
            case Unique():
                kind = "unique"
                failing = (
                    f"(SELECT count(*) FROM (SELECT {test.column} FROM {test.table} WHERE {test.column} IS NOT NULL "
                    "GROUP BY 1 HAVING count(*) > 1))"
                )
            case Relationship():
                kind = "relationships"
                failing = (
                    f"(SELECT count(*) FROM {test.table} c WHERE c.{test.column} IS NOT NULL AND NOT EXISTS "
                    f"(SELECT 1 FROM {test.to_table} p WHERE p.{test.to_column} = c.{test.column}))"
                )
            case AcceptedValues():
                kind = "accepted_values"
                failing = (
                    f"(SELECT count(DISTINCT {test.column}) FROM {test.table} "
                    f"WHERE {test.column} NOT IN ({_quoted(test.values)}))"
                )
        parts.append(
            f"SELECT '{kind}' AS test, '{test.table}' AS table_name, '{test.column}' AS \"column\", "
            f"{failing} AS failures"
        )
    return _sql(
        "SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM results",
        "results AS (" + _union(parts) + ")",
    )


def _base_of(table: str) -> str:
    """Bronze tables hold the raw rows."""
    return table.replace("bronze_", "raw_")


_TABLES = [name for name in contracts.CONTRACTS]
_COUNTS = "counts AS (" + _union(
    [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {_base_of(name)}" for name in _TABLES]
) + ")"
_EDGES = "edges(source, target) AS (VALUES " + ", ".join(
    f"('{source}', '{c.name}')" for c in contracts.CONTRACTS.values() for source in c.feeds
) + ")"


def _layer(name: str) -> str:
    layer = name.split("_", 1)[0]
    return "silver" if layer == "time" else layer


def _relationship_coverage() -> str:
    parts = []
    for c in contracts.CONTRACTS.values():
        for column, (parent, parent_column) in c.references.items():
            parts.append(
                f"SELECT '{c.name}' AS child, '{column}' AS child_column, '{parent}' AS parent, "
                f"(SELECT count(*) FROM {_base_of(c.name)} x WHERE x.{column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {_base_of(parent)} p WHERE p.{parent_column} = x.{column})) AS orphan_rows"
            )
    return _sql(_union(parts))


# All columns that can be compared, by kind.
_FK_COLUMNS = {
    "BIGINT": {
        "customer": ["c_custkey", "c_nationkey"],
        "nation": ["n_nationkey", "n_regionkey"],
        "region": ["r_regionkey"],
        "part": ["p_partkey", "p_size"],
        "supplier": ["s_suppkey", "s_nationkey"],
        "orders": ["o_orderkey", "o_custkey"],
        "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "events": ["event_id", "user_id"],
        "documents": ["doc_id", "n_chars"],
        "embeddings": ["vec_id", "label"],
        "pages": ["page_id"],
        "benchmark": ["item_id"],
        "labels": ["doc_id", "quality", "toxic"],
        "conversations": ["conv_id", "turn"],
    },
    "VARCHAR": {
        "region": ["r_name"],
        "nation": ["n_name"],
        "customer": ["c_name", "c_mktsegment"],
        "supplier": ["s_name"],
        "part": ["p_name", "p_brand", "p_type"],
        "orders": ["o_orderstatus", "o_orderpriority"],
        "lineitem": ["l_returnflag", "l_linestatus"],
        "events": ["event_type", "props"],
        "documents": ["text", "lang", "source"],
        "pages": ["url", "html"],
        "benchmark": ["text"],
        "conversations": ["role", "text"],
    },
    "DOUBLE": {
        "customer": ["c_acctbal"],
        "supplier": ["s_acctbal"],
        "part": ["p_retailprice"],
        "orders": ["o_totalprice"],
        "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "events": ["value"],
    },
    "TIMESTAMP": {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]},
}


def _foreign_keys() -> str:
    ctes, results = [], []
    for kind, tables in _FK_COLUMNS.items():
        k = kind.lower()
        values = _union(
            [
                f"SELECT '{t}' AS t, '{c}' AS c, CAST({c} AS {kind}) AS v, count(*) AS n FROM {t} GROUP BY {c}"
                for t, columns in tables.items()
                for c in columns
            ]
        )
        ctes += [
            f"vals_{k} AS ({values})",
            f"sizes_{k} AS (SELECT t, c, count(v) AS d, CAST(sum(n) AS BIGINT) AS n FROM vals_{k} GROUP BY 1, 2)",
            f"pairs_{k} AS (SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, "
            f"count(*) AS contained FROM vals_{k} a JOIN vals_{k} b ON a.v = b.v AND a.t <> b.t "
            f"JOIN sizes_{k} s ON s.t = b.t AND s.c = b.c AND s.d = s.n GROUP BY 1, 2, 3, 4)",
        ]
        results.append(
            f"SELECT p.*, s.d AS distinct_values, CAST(p.contained / s.d AS DECIMAL(5,4)) AS inclusion "
            f"FROM pairs_{k} p JOIN sizes_{k} s ON s.t = p.child_table AND s.c = p.child_column WHERE p.contained >= 0.5 * s.d"
        )
    return "WITH " + ",\n".join(ctes) + "\n" + _union(results)


def _sketched() -> str:
    columns = {
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "lineitem": [
            *["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
            *["l_returnflag", "l_linestatus", "l_shipdate"],
        ],
    }
    return _union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS \"column\", count(*) AS records, count(*) - count({c}) AS null_count, "
            f"count(DISTINCT {c}) = count(*) AS is_key FROM {t}"
            for t, names in columns.items()
            for c in names
        ]
    )


def _conformance() -> str:
    sets = ", ".join(
        f"('{name}', '{value}', '{text}')" for name, values in REFERENCE_SETS.items() for value, text in values.items()
    )
    held = _union(
        [
            f"SELECT '{name}' AS reference_set, {column} AS value, count(*) AS n_records FROM {table} GROUP BY {column}"
            for name, column, table in [
                ("order_status", "status", "silver_orders"),
                ("payment_method", "payment_method", "silver_orders"),
                ("product_category", "category", "silver_products"),
                ("country", "country", "silver_customers"),
            ]
        ]
    )
    return _sql(
        "SELECT h.reference_set, h.value, h.n_records, k.description IS NOT NULL AS conforms, k.description "
        "FROM held h LEFT JOIN known k ON h.reference_set = k.name AND h.value = k.value",
        f"known(name, value, description) AS (VALUES {sets})",
        f"held AS ({held})",
    )


def _column_tags() -> str:
    tags = []
    for rule in DOMAIN_TAGS:
        tests = [f"contains(\"column\", '{part}')" for part in rule.parts] + [f"starts_with(\"column\", '{x}')" for x in rule.starts]
        if rule.wholes:
            tests.append(f'"column" IN ({_quoted(rule.wholes)})')
        tags.append(f"CASE WHEN {' OR '.join(tests)} THEN '{rule.label}' END")
    tag_list = f"list_sort(list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL))"
    terms = (
        "list_sort(list_filter(["
        "CASE WHEN starts_with(table_name, 'silver') THEN 'SilverLayer' ELSE 'RawLanding' END, "
        "CASE WHEN contains(table_name, 'customer') THEN 'Customer' END, "
        "CASE WHEN contains(table_name, 'product') THEN 'Product' END, "
        "CASE WHEN contains(table_name, 'order') THEN 'Order' END], lambda x: x IS NOT NULL))"
    )
    return _sql(
        "SELECT CASE WHEN starts_with(table_name, 'silver') THEN 'retail_silver' ELSE 'retail_raw' END AS schema_name, "
        "table_name, \"column\", CASE WHEN starts_with(table_name, 'silver') THEN 'Silver' ELSE 'Raw' END AS layer, "
        f"array_to_string(list_concat(['Profiled'], {tag_list}), ',') AS tags, "
        f"array_to_string({terms}, ',') AS terms, null_count FROM profiles",
        _PROFILES,
    )


_ORDERS = "SELECT * FROM silver_orders"
_DAILY = "SELECT * FROM gold_daily_sales"
_CATEGORY = "SELECT * FROM gold_category_performance"
_CUSTOMER = "SELECT * FROM gold_customer_360"
_FACT = "SELECT * FROM silver_sales_enriched"
_CUTOFF = "TIMESTAMP '1998-01-01'"


def _both(table: str, columns: str = "*") -> str:
    return _sql(
        f"SELECT 'stored' AS path, {columns} FROM {table} UNION ALL SELECT 'staged', {columns} FROM {table}"
    )


def _last_events(step: str) -> str:
    return (
        "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY user_id ORDER BY step DESC, ts DESC, event_id DESC) AS rn FROM ("
        f"SELECT *, CASE event_type {step} END AS step FROM events)) WHERE rn = 1"
    )


ORACLE: dict[str, str] = {
    "csv_text_scan": _sql(_ORDERS),
    "csv_inferred_scan": _sql("SELECT * FROM raw_products"),
    "csv_positional_scan": _sql("SELECT * FROM silver_order_items"),
    "coerce_accepted": """
        SELECT event_id, CAST(trunc(value) AS BIGINT) AS amount, value AS score,
               event_type IN ('purchase', 'click') AS flagged,
               CASE WHEN event_type <> 'signup' THEN props END AS note
        FROM events WHERE event_type NOT IN ('error', 'view')""",
    "coerce_rejected": """
        SELECT CASE event_type WHEN 'error' THEN 'amount: required but empty' ELSE 'amount: not a bigint' END
                 AS reject_reason, count(*) AS n_records
        FROM events WHERE event_type IN ('error', 'view') GROUP BY 1""",
    "coerce_outcome": """
        SELECT count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS produced,
               count(*) FILTER (WHERE event_type IN ('error', 'view')) AS skipped FROM events""",
    "bronze_customers": _bronze("customers"),
    "bronze_products": _bronze("products"),
    "bronze_orders": _bronze("orders"),
    "bronze_order_items": _bronze("order_items"),
    "bronze_files": "SELECT 'lineitem.parquet' AS _source_file, count(*) AS row_count FROM lineitem",
    "bronze_stage": _sql(
        "SELECT *, TIMESTAMP '2026-01-02 03:04:05' AS _ingested_at, 'medallion_flow' AS _ingested_by, "
        "'raw_orders.csv' AS _source_file, 'run-7' AS _ingest_batch_id FROM raw_orders"
    ),
    "silver_customers": _sql("SELECT * FROM silver_customers"),
    "silver_products": _sql("SELECT * FROM silver_products"),
    "silver_orders": _sql(_ORDERS),
    "silver_order_items": _sql("SELECT * FROM silver_order_items"),
    "sales_enriched": _sql(_FACT),
    "sales_enriched_staged": _sql(_FACT),
    "orphan_policy": _sql("""
        SELECT CASE WHEN o.order_id IS NULL THEN 'order' WHEN p.product_id IS NULL THEN 'product' ELSE 'customer' END
                 AS missing, count(*) AS dropped_lines, CAST(sum(oi.quantity) AS BIGINT) AS dropped_units
        FROM silver_order_items oi LEFT JOIN silver_orders o ON oi.order_id = o.order_id
        LEFT JOIN silver_products p ON oi.product_id = p.product_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        WHERE o.order_id IS NULL OR p.product_id IS NULL OR c.customer_id IS NULL GROUP BY 1"""),
    "daily_sales": _sql(_DAILY),
    "category_performance": _sql(_CATEGORY),
    "category_performance_direct": _sql("""
        SELECT category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units,
               CAST(sum(net_amount) AS DECIMAL(24,2)) AS total_revenue,
               CAST(sum(net_amount) / nullif(sum(quantity), 0) AS DECIMAL(14,2)) AS avg_revenue_per_unit
        FROM silver_sales_enriched WHERE status = 'completed' GROUP BY category"""),
    "customer_360": _sql(_CUSTOMER),
    "customer_360_expanded": _sql(_CUSTOMER),
    "customer_360_recent": _sql(_CUSTOMER, since="AND order_date >= DATE '2001-07-01'"),
    "adhoc_daily_gross": _sql("SELECT * FROM daily_gross"),
    "customer_leaderboard": _sql("""
        SELECT concat(first_name, ' ', last_name) AS customer_name, country, count(*) AS total_orders,
               CAST(sum(cents) * 0.01 AS DECIMAL(24,2)) AS total_revenue
        FROM (SELECT order_id, sum(cents) AS cents FROM raw_parts GROUP BY order_id) p, raw_orders o, raw_customers c
        WHERE o.order_id = p.order_id AND c.customer_id = o.customer_id
        GROUP BY first_name, last_name, country ORDER BY sum(cents) DESC, customer_name LIMIT 10"""),
    "status_breakdown": _sql("SELECT status, count(*) AS row_count FROM silver_orders GROUP BY status"),
    "top_categories": _sql(f"{_CATEGORY} ORDER BY total_revenue DESC, category LIMIT 5"),
    "latest_days": _sql(f"{_DAILY} ORDER BY order_date DESC, category LIMIT 10"),
    "daily_report": _sql(f"{_DAILY} ORDER BY order_date, category"),
    "customer_report": _sql(f"{_CUSTOMER} ORDER BY lifetime_value DESC, customer_id"),
    "fact_totals": _sql(
        "SELECT count(*) AS lines, CAST(sum(gross_amount) AS DECIMAL(24,2)) AS gross, "
        "CAST(sum(net_amount) AS DECIMAL(24,2)) AS net FROM silver_sales_enriched"
    ),
    "layer_counts": _sql(
        "SELECT split_part(table_name, '/', 1) AS layer, split_part(table_name, '/', 2) AS table_name, row_count "
        "FROM labelled",
        "labelled AS ("
        + _union(
            [f"SELECT '{_layer(n)}/{n}' AS table_name, count(*) AS row_count FROM {_base_of(n)}" for n in _TABLES]
        )
        + ")",
    ),
    "checksums": _sql("""
        SELECT 'daily_sales' AS mart, CAST(sum(net_revenue) AS DECIMAL(24,2)) AS checksum FROM gold_daily_sales
        UNION ALL SELECT 'category_performance', CAST(sum(total_revenue) AS DECIMAL(24,2))
        FROM gold_category_performance
        UNION ALL SELECT 'customer_360', CAST(sum(lifetime_value) AS DECIMAL(24,2)) FROM gold_customer_360"""),
    "between_dates": _sql(f"{_DAILY} WHERE order_date BETWEEN DATE '1996-02-10' AND DATE '1996-04-20'"),
    "daily_sales_union": _both("gold_daily_sales"),
    "category_performance_union": _both(
        "gold_category_performance", "category, total_orders, total_units, total_revenue"
    ),
    "customer_360_union": _both(
        "gold_customer_360",
        "customer_id, completed_orders, returned_orders, pending_orders, cancelled_orders, lifetime_value",
    ),
    "reconcile_marts": _sql(
        _union(
            [
                f"SELECT '{m}' AS mart, 'stored' AS reference, 'staged' AS other, "
                f"(SELECT count(*) FROM (SELECT * FROM gold_{m} EXCEPT SELECT * FROM gold_{m})) AS ref_only, "
                f"(SELECT count(*) FROM (SELECT * FROM gold_{m} EXCEPT SELECT * FROM gold_{m})) AS other_only, "
                "CAST(0 AS BIGINT) AS copies_differ, 'PASS' AS status"
                for m in contracts.MARTS
            ]
        )
    ),
    "reconcile_gross": _sql("""
        SELECT 'daily_sales' AS mart, 'net' AS reference, 'gross' AS other,
          (SELECT count(*) FROM (SELECT * FROM gold_daily_sales EXCEPT SELECT * FROM daily_gross)) AS ref_only,
          (SELECT count(*) FROM (SELECT * FROM daily_gross EXCEPT SELECT * FROM gold_daily_sales)) AS other_only,
          CAST(0 AS BIGINT) AS copies_differ,
          'FAIL' AS status"""),
    "except_rows": _sql(f"{_DAILY} EXCEPT SELECT * FROM daily_gross"),
    "reconcile_delta": _sql("""
        SELECT order_date, category, n.order_count AS net_orders, n.net_revenue AS net_revenue,
               g.order_count AS gross_orders, g.gross_revenue AS gross_revenue,
               CAST(n.net_revenue - g.gross_revenue AS DECIMAL(25,2)) AS delta
        FROM gold_daily_sales n JOIN daily_gross g USING (order_date, category)
        WHERE n.order_count <> g.order_count OR n.net_revenue <> g.gross_revenue"""),
    "count_parity": _sql(
        "SELECT table_name, row_count AS our_rows, row_count AS their_rows, true AS matches FROM counts "
        "WHERE table_name IN ('silver_sales_enriched', 'gold_daily_sales', 'gold_category_performance', "
        "'gold_customer_360')",
        _COUNTS,
    ),
    "value_parity": _sql(
        "SELECT measure, total AS our_total, total AS their_total, true AS matches FROM totals",
        """totals AS (
        SELECT 'daily_sales.net_revenue' AS measure, CAST(sum(net_revenue) AS DECIMAL(24,2)) AS total
        FROM gold_daily_sales
        UNION ALL SELECT 'category_performance.total_revenue', CAST(sum(total_revenue) AS DECIMAL(24,2))
        FROM gold_category_performance
        UNION ALL SELECT 'customer_360.lifetime_value', CAST(sum(lifetime_value) AS DECIMAL(24,2))
        FROM gold_customer_360)""",
    ),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
    "orphans": _sql("""
        SELECT customer_id, count(*) AS n_records FROM silver_orders
        WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM silver_customers) GROUP BY 1"""),
    "accepted_values": _sql(
        "SELECT payment_method, count(*) AS n_records FROM silver_orders "
        f"WHERE payment_method NOT IN ({_quoted(REFERENCE_SETS['payment_method'])}) GROUP BY 1"
    ),
    "not_null_suite": _sql(
        _union(
            [
                f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS failures FROM raw_customers"
                for c in _COLUMNS["silver_customers"]
            ]
        )
    ),
    "test_results": _test_rows(),
    "dq_profile": _sql("SELECT * FROM profiles", _PROFILES),
    "key_candidates": _sql(
        'SELECT table_name, "column", records FROM profiles '
        "WHERE null_count = 0 AND distinct_count = records AND records > 0",
        _PROFILES,
    ),
    "foreign_key_candidates": _foreign_keys(),
    "column_sketches": _sketched(),
    "dq_columns": _sql("SELECT * FROM scores", _scores()),
    "dq_scorecard": _sql("SELECT * FROM scorecard", _scores(), _SCORECARD),
    "dq_kpis": _sql(
        f"SELECT count(*) AS n_assets, CAST({_mean('overall', 100)} AS DECIMAL(5,2)) AS avg_dq, "
        "CAST(sum(records) AS BIGINT) AS total_records, (SELECT count(DISTINCT data_class) FROM detected "
        'WHERE assigned) AS n_classes, CAST(sum("columns") AS BIGINT) AS n_columns FROM scorecard',
        _scores(),
        _SCORECARD,
        _detected(0.8),
    ),
    "data_classes": _sql("SELECT * FROM detected WHERE name_matches", _detected(0.8)),
    "data_classes_by_value": _sql("SELECT * FROM detected", _detected(0.8)),
    "class_catalog": _sql(
        "SELECT data_class, string_agg(table_name || '.' || \"column\", ',' ORDER BY table_name || '.' || \"column\") "
        'AS "columns" FROM detected WHERE assigned GROUP BY 1',
        _detected(0.8),
    ),
    "mask_pii": _sql("""
        SELECT customer_id, first_name, last_name,
               regexp_replace(regexp_replace(regexp_replace(email, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'),
                              '[0-9]', 'n', 'g') AS email,
               signup_date, country FROM silver_customers"""),
    "mask_hashed": "SELECT conv_id, turn, role, sha256(text) AS text FROM conversations",
    "ref_conformance": _conformance(),
    "column_tags": _column_tags(),
    "lineage_counts": _sql(
        "SELECT e.source, e.target, s.row_count AS source_rows, t.row_count AS target_rows FROM edges e "
        "JOIN counts s ON e.source = s.table_name JOIN counts t ON e.target = t.table_name",
        _COUNTS,
        _EDGES,
    ),
    "lineage_reach": _sql(
        "SELECT r.source, r.target, CAST(min(r.distance) AS INTEGER) AS distance, any_value(t.row_count) AS target_rows "
        "FROM reach r JOIN counts t ON r.target = t.table_name WHERE starts_with(r.source, 'raw_') GROUP BY 1, 2",
        _COUNTS,
        _EDGES,
        "reach AS (SELECT source, target, 1 AS distance FROM edges UNION ALL "
        "SELECT r.source, e.target, r.distance + 1 FROM reach r JOIN edges e ON r.target = e.source)",
    ),
    "relationship_coverage": _relationship_coverage(),
    "metric_month": _sql("""
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_date__month,
               CAST(sum(net_revenue) AS DECIMAL(24,2)) AS total_net_revenue,
               CAST(sum(order_count) AS BIGINT) AS total_orders, CAST(sum(units_sold) AS BIGINT) AS total_units_sold
        FROM gold_daily_sales GROUP BY 1"""),
    "metric_country": _sql("""
        SELECT customer_country, status, count(*) AS order_line_count,
               CAST(sum(gross_amount) AS DECIMAL(24,2)) AS gross_revenue,
               CAST(sum(net_amount) AS DECIMAL(24,2)) AS net_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
        FROM silver_sales_enriched WHERE payment_method <> '5-low' GROUP BY 1, 2"""),
    "metric_entity_keys": _sql(
        "SELECT CAST(order_date AS VARCHAR) || '|' || category AS daily_sales_key, net_revenue FROM gold_daily_sales"
    ),
    "time_spine": _sql("SELECT date_day FROM calendar"),
    "spine_daily_revenue": _sql("""
        SELECT g.category, date_day, coalesce(order_count, 0) AS order_count, coalesce(units_sold, 0) AS units_sold,
               coalesce(net_revenue, CAST(0 AS DECIMAL(24,2))) AS net_revenue
        FROM calendar CROSS JOIN (SELECT DISTINCT category FROM gold_daily_sales) g
        LEFT JOIN gold_daily_sales s ON s.category = g.category AND s.order_date = date_day"""),
    "partition_stats": _sql("""
        SELECT CAST((year(order_date) - 1970) * 12 + month(order_date) - 1 AS INTEGER) AS month_ordinal,
               strftime(order_date, '%Y-%m') AS month, count(*) AS row_count, true AS stored
        FROM silver_orders GROUP BY 1, 2"""),
    "refresh_mart": _sql(_DAILY),
    "append_to_emptied": _sql("SELECT * FROM raw_products"),
    "gold_view": _sql("SELECT category, total_orders, total_units, total_revenue FROM gold_category_performance"),
    "reporting_customer_360": _sql(
        "SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id, "
        "CAST(lifetime_value AS DECIMAL(18,2)) AS lifetime_value), true AS is_stamped FROM gold_customer_360"
    ),
    "reporting_daily_sales": _sql(
        "SELECT * REPLACE (CAST(net_revenue AS DECIMAL(18,2)) AS net_revenue), true AS is_stamped FROM gold_daily_sales"
    ),
    "reporting_category_performance": _sql("""
        SELECT category, total_orders, total_units AS total_units_sold,
               CAST(total_revenue AS DECIMAL(18,2)) AS total_net_revenue,
               CAST(avg_revenue_per_unit AS DECIMAL(18,2)) AS avg_order_value, true AS is_stamped
        FROM gold_category_performance"""),
    "incremental_load": _sql(_ORDERS),
    "incremental_merge": _sql(
        "SELECT * REPLACE (CASE WHEN status = 'pending' THEN 'completed' ELSE status END AS status) FROM silver_orders"
    ),
    "monthly_load": _sql("""
        SELECT order_id, customer_id, order_ts, order_date,
               CASE WHEN status = 'pending' THEN 'completed' ELSE status END AS status, payment_method,
               CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM silver_orders"""),
    "stream_changes": _sql(_ORDERS),
    "stream_delta_enriched": _sql(_FACT),
    "delta_daily_sales": _sql(_DAILY),
    "delta_customer_360": _sql(_CUSTOMER),
    "sql_pushdown_read": """
        SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(l_quantity) AS BIGINT) AS units
        FROM (SELECT l_orderkey, l_quantity FROM lineitem WHERE l_discount > 0.05) l, orders
        WHERE l_orderkey = o_orderkey AND o_orderstatus = 'F' GROUP BY o_orderpriority""",
    "batch_labels": _sql("SELECT strftime(order_ts, 'flow_%Y%m%d_%H%M') AS batch_id, count(*) AS row_count FROM raw_orders GROUP BY 1"),
    "silver_stamps": _sql(
        _union([f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS stamped FROM {t}" for t in _SCORED])
    ),
    "stream_rule_customers": _sql("SELECT * FROM silver_customers WHERE customer_id % 7 <> 0"),
    "layer_check": _sql(
        "SELECT layer, CAST(sum(n) AS BIGINT) AS row_count, 'PASS' AS status FROM sized GROUP BY layer",
        "sized AS (" + _union([f"SELECT '{_layer(t)}' AS layer, count(*) AS n FROM {_base_of(t)}" for t in _TABLES]) + ")",
    ),
    "table_as_select": _sql(
        "SELECT category, max(order_date) AS last_day, CAST(sum(units_sold) AS BIGINT) AS units FROM gold_daily_sales GROUP BY category"
    ),
    "latest_months": _sql("""
        SELECT CAST((year(m) - 1970) * 12 + month(m) - 1 AS INTEGER) AS month_ordinal, strftime(m, '%Y-%m') AS month, row_count
        FROM (SELECT date_trunc('month', order_date) AS m, count(*) AS row_count FROM silver_orders GROUP BY 1)
        ORDER BY m DESC LIMIT 3"""),
    "model_problems": _sql("""
        SELECT 'daily_sales' AS model, 0 AS "case", 0 AS problems, count(*) AS row_count FROM gold_daily_sales
        UNION ALL SELECT 'sales_orders', 1, 0, count(*) FROM silver_sales_enriched
        UNION ALL SELECT 'daily_sales', 2, 6, count(*) FROM silver_customers"""),
    "reconcile_digest": _sql("""
        SELECT order_date, category, order_count, units_sold, net_revenue,
               count(*) FILTER (side = 'l') AS left_copies, count(*) FILTER (side = 'r') AS right_copies
        FROM (SELECT 'l' AS side, * FROM gold_daily_sales UNION ALL SELECT 'r', * FROM daily_gross) GROUP BY ALL
        HAVING left_copies <> right_copies"""),
    "reconcile_builds_digest": _sql(
        "SELECT *, CAST(1 AS BIGINT) AS left_copies, CAST(1 AS BIGINT) AS right_copies FROM silver_sales_enriched WHERE false"
    ),
    "sales_enriched_bucketed": _sql(_FACT),
    "stream_bounded_enriched": _sql(_FACT),
    "published_mart": _sql(_DAILY),
    "version_read": _sql(
        f"SELECT status, count(*) AS row_count FROM silver_orders WHERE order_ts < {_CUTOFF} GROUP BY status"
    ),
    "version_as_of": _sql(
        f"SELECT 'first' AS version, count(*) AS row_count FROM silver_orders WHERE order_ts < {_CUTOFF}"
    ),
    "version_snapshots": _sql(f"""
        SELECT CAST(1 AS BIGINT) AS version, 'overwrite' AS operation, count(*) AS row_count FROM silver_orders
        WHERE order_ts < {_CUTOFF}
        UNION ALL SELECT 2, 'append', count(*) FROM silver_orders WHERE order_ts >= {_CUTOFF}
        UNION ALL SELECT 3, 'overwrite', count(*) FROM silver_orders"""),
    "version_history": _sql("""
        SELECT v AS version, CASE WHEN v > 1 THEN v - 1 END AS parent_version, true AS is_current_ancestor
        FROM (SELECT DISTINCT CASE WHEN order_ts < TIMESTAMP '1998-01-01' THEN CAST(1 AS BIGINT) ELSE 2 END AS v
              FROM silver_orders)"""),
    "version_diff": _sql(f"""
        SELECT count(*) FILTER (WHERE order_ts < {_CUTOFF}) AS before_rows, count(*) AS after_rows,
               CAST(0 AS BIGINT) AS removed, count(*) FILTER (WHERE order_ts >= {_CUTOFF}) AS added,
               CAST(0 AS BIGINT) AS copies_differ FROM silver_orders"""),
    "latest_per_key": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "upsert_latest": _last_events("WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4"),
    "upsert_compacted": _last_events("WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3 ELSE 4"),
    "stream_customers": _sql("SELECT * FROM silver_customers"),
    "stream_products": _sql("SELECT * FROM silver_products"),
    "stream_replay": _sql("SELECT * FROM silver_products"),
    "stream_orders": _sql(_ORDERS),
    "stream_order_items": _sql("SELECT * FROM silver_order_items"),
    "stream_enriched": _sql(_FACT),
    "stream_static_enriched": _sql(_FACT),
    "stream_gold": _sql(_CATEGORY),
    "stream_gold_daily_sales": _sql(_DAILY),
    "stream_gold_customer_360": _sql(_CUSTOMER),
    "customer_labels": _sql(
        "SELECT customer_id, CAST(customer_id AS VARCHAR) || '|' || email AS label FROM raw_customers"
    ),
}
