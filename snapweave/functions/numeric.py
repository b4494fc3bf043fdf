"""Locale-tolerant number parsing (numbers that arrive as text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.functions.keys import WHITESPACE

# A plain decimal literal as Python's float() reads it, after whitespace is
# removed and commas became dots. Spark alone would also accept "1d", "1.0f"
# or hex floats, so the text is checked before the cast.
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"


def to_numeric(c: Column | str) -> Column:
    """Text to DOUBLE: "1 234,50" -> 1234.5, "1,234.50" -> NULL, junk -> NULL.

    All whitespace (no-break space included) is removed, every comma becomes a
    dot, underscores between digits are dropped. ``inf`` stays infinite, NaN
    and anything unparsable become NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    # One pass: commas become dots, whitespace characters are deleted.
    s = F.translate(c, "," + WHITESPACE, ".")
    s = F.when(s.contains("_"), F.regexp_replace(s, r"(?<=[0-9])_(?=[0-9])", "")).otherwise(s)
    neg_inf = F.lit(float("-inf")).cast("double")
    pos_inf = F.lit(float("inf")).cast("double")
    return (
        F.when(s.rlike(_DECIMAL), s.try_cast("double"))
        .when(s.rlike(_INFINITY), F.when(s.startswith("-"), neg_inf).otherwise(pos_inf))
        .otherwise(F.lit(None).cast("double"))
    )


def to_numeric_any(c: Column | str, dtype: T.DataType) -> Column:
    """``to_numeric`` for a column of any type: numbers pass, booleans are 0/1."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.StringType):
        return to_numeric(c)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
    return to_numeric(c.cast("string"))
