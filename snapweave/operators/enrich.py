"""Lookups that a contract declares: a column from a reference table, and a value worked out with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.contracts import FX, Lookup
from snapweave.session import broadcast_if_small

RATES_MAX_ROWS = 10_000  # a currency table never comes close; larger is refused for broadcast


def lookup_value(lookup: Lookup, columns: list[str]) -> dict[str, Column]:
    """The value's column, if the frame has every factor (NULL where a factor is NULL)."""
    product = " * ".join(f"`{f}`" for f in lookup.factors)
    return {lookup.value: F.expr(product)} if set(lookup.factors) <= set(columns) else {}


def with_lookup(df: DataFrame, reference: DataFrame, lookup: Lookup) -> DataFrame:
    """``df`` with the lookup's column and value.

    A frame without the lookup's field has nothing to look up and stays as it is.
    Unknown or NULL keys get NULL. The reference side is broadcast after its row
    count is checked; it must be unique per key (``load_rates`` checks that), so
    no row can fan out.
    """
    for key in {lookup.on}.intersection(df.columns):
        side = broadcast_if_small(reference.select(key, lookup.adds), RATES_MAX_ROWS)
        df = df.join(side, key, "left").select(*df.columns, lookup.adds)
    return df.withColumns(lookup_value(lookup, df.columns))


def enrich_rates(df: DataFrame, rates: DataFrame | None, lookup: Lookup = FX) -> DataFrame:
    """FX rates by currency and the value of a line; without rates (an absent file) nothing is added."""
    return df if rates is None else with_lookup(df, rates, lookup)
