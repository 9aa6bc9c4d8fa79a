"""Output convention of registered queries, so that results compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, amounts as DOUBLE, doubles to 4 decimals, dates and times as text."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            column = F.round(column.cast("double"), 4) + F.lit(0.0)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            text = column.cast("string")
            column = F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")
        columns.append(column.alias(field.name))
    return df.select(*columns)
