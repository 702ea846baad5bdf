"""A small hand-made shop with every kind of dirty row."""

from orestrata.sources.starmap import Entities

CUSTOMERS = [
    ("1", " Amina ", "Khan ", " AMINA@X.COM ", "2025-10-29", " de "),
    ("2", "Lukas", "Weber", "lukas@x.com", "2025-10-07", "DE"),
    ("3", "No", "Mail", None, "2025-12-10", "FR"),
    ("4", "Blank", "Mail", "  ", "2025-12-11", "FR"),
    ("5", "No", "Orders", "idle@x.com", "2026-01-01", "IT"),
]
PRODUCTS = [
    ("10", " Pen ", "Office", "0.50"),
    ("11", "Lamp", " Home ", "100.005"),
    ("12", "Tea", "Grocery", "3.99"),
    (None, "Ghost", "Home", "1.00"),
]
ORDERS = [
    ("100", "1", "2026-01-02 10:00:00", " Completed ", "CARD"),
    ("101", "1", "2026-01-03 11:00:00", "returned", "card"),
    ("102", "2", "2026-02-01 00:00:00", "completed", " PayPal"),
    ("103", "3", "2026-02-02 00:00:00", "completed", "card"),  # customer without email
    ("104", "99", "2026-02-03 00:00:00", "completed", "card"),  # unknown customer
    ("105", "2", "2026-02-04 00:00:00", "pending", "card"),
    ("106", "2", "2026-02-05 00:00:00", "cancelled", "card"),
    (None, "1", "2026-02-06 00:00:00", "completed", "card"),
]
ITEMS = [
    ("1000", "100", "10", "1", "0.15"),  # 0.425 -> 0.43
    ("1001", "100", "11", "2", "0.00"),
    ("1002", "100", "12", "1", "0.10"),
    ("1003", "101", "12", "5", "0.00"),
    ("1004", "102", "11", "1", "0.05"),
    ("1005", "102", "10", "0", "0.00"),  # no units
    ("1006", "102", "10", "-1", "0.00"),
    ("1007", "102", "10", None, "0.00"),
    ("1008", "103", "10", "1", "0.00"),
    ("1009", "104", "10", "1", "0.00"),
    ("1010", "999", "10", "1", "0.00"),  # unknown order
    ("1011", "102", "77", "1", "0.00"),  # unknown product
    ("1012", "105", "12", "2", "0.00"),
    ("1013", "106", "12", "1", "0.00"),
]


def entities(spark) -> Entities:
    return Entities(
        customers=spark.createDataFrame(
            CUSTOMERS,
            "customer_id string, first_name string, last_name string, email string, signup_date string, country string",
        ),
        products=spark.createDataFrame(
            PRODUCTS, "product_id string, product_name string, category string, unit_price string"
        ),
        orders=spark.createDataFrame(
            ORDERS, "order_id string, customer_id string, order_ts string, status string, payment_method string"
        ),
        order_items=spark.createDataFrame(
            ITEMS, "order_item_id string, order_id string, product_id string, quantity string, discount_pct string"
        ),
    )


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)
