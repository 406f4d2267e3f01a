"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Round the floating columns of a result, so that engines agree on its last digits."""

    def one(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f.name).cast("double"), places).alias(f.name)
        return F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def r(expression: str, places: int = 6) -> str:
    """The same rounding in SQL, without a negative zero."""
    return f"(round({expression}, {places}) + 0.0::DOUBLE)"


def numeric_long(columns, source: str, keep: str = "id, y") -> str:
    """SQL for (feature, value) rows of the given numeric columns."""
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in columns)
    return f"SELECT {keep}, unnest([{names}]) AS feature, unnest([{values}]) AS v FROM {source}"


def text_long(columns, source: str, keep: str = "id, y") -> str:
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"SELECT {keep}, unnest([{names}]) AS feature, unnest([{values}]) AS v FROM {source}"
