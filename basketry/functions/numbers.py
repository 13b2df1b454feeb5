"""Lenient numbers: NULL for whatever is not a plain decimal number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def number(df: DataFrame, name: str) -> Column:
    """Column as an exact number. Text goes through a pattern first, because a bare cast
    also accepts spellings such as ``1d`` and ``NaN``."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return F.col(name)
    text = F.col(name).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("decimal(38,10)"))


def whole(df: DataFrame, name: str, dtype: str) -> Column:
    """Strict cast of a validated whole-number column."""
    return number(df, name).cast(dtype)
