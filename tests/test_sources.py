"""Files and text rows against a contract."""

from datetime import date

import pytest
from pyspark.sql import types as T
from shop import rows

from orestrata import contracts
from orestrata.sources import coerce, files


def _write(folder, text):
    path = f"{folder}/in.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_text_scan(spark, folder):
    path = _write(folder, "order_id,customer_id,order_ts,status,payment_method\n1, 2 ,x,,y\n")
    df = files.csv_text(spark, path, contracts.RAW_ORDERS.names)
    assert {f.dataType for f in df.schema} == {T.StringType()}
    assert df.first()[:] == ("1", " 2 ", "x", None, "y")


def test_inferred_scan(spark, folder):
    path = _write(folder, "id,price,day,at,name\n1,49.9,2026-01-02,2026-01-02 03:04:05,a\n")
    assert [f.dataType.simpleString() for f in files.csv_inferred(spark, path).schema] == [
        "int",
        "double",
        "date",
        "timestamp_ntz",
        "string",
    ]


def test_positional_scan_ignores_names(spark, folder):
    path = _write(folder, "x,y\n7,0.5\n")
    schema = T.StructType([T.StructField("product_id", T.IntegerType()), T.StructField("unit_price", T.DoubleType())])
    assert files.csv_positional(spark, path, schema).first().asDict() == {"product_id": 7, "unit_price": 0.5}
    bad = _write(folder, "x,y\nseven,0.5\n")
    with pytest.raises(Exception):
        files.csv_positional(spark, bad, schema).collect()


def test_source_file_and_sql(spark, folder):
    path = _write(folder, "a,b\n1,2\n")
    df = files.csv_text(spark, path, ["a", "b"])
    assert df.select(files.source_file()).first()[0] == "in.csv"
    assert files.sql(spark, "select a from {t} where b = '2'", t=df).first()[0] == "1"


CONTRACT = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("big", T.LongType(), True),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("day", T.DateType(), True),
    ]
)


@pytest.mark.parametrize(
    "cell, value",
    [
        ("1", 1),
        (" 12\t", 12),
        ("1.0", 1),
        ("-1.9", -1),
        ("1e3", 1000),
        ("+5", 5),
        ("1_000", 1000),
        (".5", 0),
        ("", None),
        ("x", None),
        ("1__0", None),
        ("_1", None),
        ("1.0d", None),
        ("0x10", None),
        ("nan", None),
        ("12e", None),
        ("3000000000", None),
        ("3e9", None),
        (None, None),
    ],
)
def test_whole_numbers(spark, cell, value):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False)])
    row = coerce.coerce(spark.createDataFrame([(cell,)], "id string"), schema).first()
    assert row["id"] == value
    assert (row[coerce.REASON] is None) == (value is not None)


def test_coercion(spark):
    text = "id string, big string, price string, ok string, name string, day string"
    df = spark.createDataFrame(
        [
            ("1", "", "0.5", "Yes", "", "2026-01-02"),
            ("2", "9000000000", "inf", "no", " a ", ""),
            ("", "1", "1", "1", "b", ""),
            ("4", "1", "", "true", "c", ""),
            ("5", "1", "1", "", "d", ""),
            ("6", "1", "1", "1", "e", "2026-13-01"),
        ],
        text,
    )
    coerced = coerce.coerce(df, CONTRACT)
    assert rows(coerce.accepted(coerced)) == [
        (1, None, 0.5, True, None, date(2026, 1, 2)),
        (2, 9000000000, float("inf"), False, "a", None),
    ]
    assert sorted(r[coerce.REASON] for r in coerce.rejected(coerced).collect()) == [
        "day: not a date",
        "id: required but empty",
        "ok: required but empty",
        "price: required but empty",
    ]
    assert coerce.outcome(coerced).first()[:] == (2, 4)


def test_missing_column_counts_as_empty(spark):
    coerced = coerce.coerce(spark.createDataFrame([("1",)], "id string"), CONTRACT)
    assert coerced.first()[coerce.REASON] == "price: required but empty"
