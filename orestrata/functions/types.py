"""SQL type names -> catalog type names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type name, catalog type, length (text types only).
CATALOG_TYPES = [
    ("varchar", "VARCHAR", 65535),
    ("char", "CHAR", 255),
    ("integer", "INT", None),
    ("int", "INT", None),
    ("bigint", "BIGINT", None),
    ("double", "DOUBLE", None),
    ("float", "FLOAT", None),
    ("boolean", "BOOLEAN", None),
    ("date", "DATE", None),
    ("timestamp", "TIMESTAMP", None),
    ("timestamp with time zone", "TIMESTAMPZ", None),
    ("timestamp(3)", "TIMESTAMP", None),
]

_DECIMAL = r"^decimal\((\d+),\s*(\d+)\)"


def catalog_type(type_name: Column) -> Column:
    """Struct(data_type, length, precision, scale, display); UNKNOWN for any other type."""
    name = F.lower(F.trim(type_name))
    is_decimal = name.rlike(_DECIMAL)
    data_type = F.when(is_decimal, F.lit("DECIMAL"))
    length = F.when(is_decimal, F.lit(None).cast("int"))
    for sql_name, catalog_name, size in CATALOG_TYPES:
        data_type = data_type.when(name == sql_name, F.lit(catalog_name))
        length = length.when(name == sql_name, F.lit(size).cast("int"))

    def digits(group: int) -> Column:
        return F.when(is_decimal, F.regexp_extract(name, _DECIMAL, group).try_cast("int"))

    return F.struct(
        data_type.otherwise(F.lit("UNKNOWN")).alias("data_type"),
        length.alias("length"),
        digits(1).alias("precision"),
        digits(2).alias("scale"),
        type_name.alias("display"),
    )
