"""Weekly snapshot: resolved extract -> one clean row per key and week.

``transform`` is one lazy DataFrame function; only the row count of the rates
lookup is taken while it is built (it decides the broadcast). The week is a column, so any number of weeks (and years) go through in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from snapweave.contracts import Contract, Field, find_contract
from snapweave.functions.dates import DEFAULT_YEAR, report_monday
from snapweave.functions.keys import composite_key, key_complete, normalize_key
from snapweave.functions.numeric import to_numeric_any
from snapweave.operators.compact import compact_rows
from snapweave.operators.enrich import enrich_rates

WEEK_COLS = ("report_year", "report_week")
ORDER_COL = "_order"      # row order of the source (file, row) used to pick the last row
ABSENT_COL = "_absent"    # optional fields a source file did not have


def snapshot_columns(df: DataFrame, contract: Contract, hidden: tuple[str, ...] = ()) -> list[str]:
    fields = [f for f in contract.names if f in df.columns]
    added = (contract.lookup.adds, contract.lookup.value) if contract.lookup is not None else ()
    extra = [c for c in added if c in df.columns]
    keep = [c for c in (ABSENT_COL, *hidden) if c in df.columns]
    return fields + ["key", "report_date", "report_week", "report_year"] + extra + keep


def cleaned(field: Field, dtype: DataType) -> Column:
    """A field's cell as the contract wants it: a number, a padded key, or as it is."""
    if field.width:
        return normalize_key(field.name, field.width)
    return to_numeric_any(field.name, dtype) if field.numeric else F.col(field.name)


def transform(df: DataFrame, contract: Contract, rates: DataFrame | None = None,
              week: int | None = None, year: int = DEFAULT_YEAR, keep: str = "last",
              arrival: bool = False) -> DataFrame:
    """Coerce numbers, pad keys, key and drop incomplete rows, keep the last
    row per key and week, stamp the report date, add FX rates.

    ``df`` carries ``report_year``/``report_week`` columns, or a single
    ``week`` (and ``year``) is given for the whole frame. With ``arrival`` the
    rows keep their place of arrival (``_order``) for the sink.
    """
    out = df
    if week is not None:
        out = out.withColumns({"report_year": F.lit(year), "report_week": F.lit(week)})
    types = {c.name: c.dataType for c in out.schema.fields}
    out = out.withColumns({f.name: cleaned(f, types[f.name]) for f in contract.fields if f.name in types})

    parts = [normalize_key(k) for k in contract.key]
    out = out.withColumn("key", composite_key(parts)).filter(key_complete(parts))

    order = [ORDER_COL] if ORDER_COL in out.columns else None
    out = compact_rows(out, key_cols=[*WEEK_COLS, "key"], keep=keep, order_cols=order)

    monday = report_monday(F.col("report_week"), F.col("report_year"))
    out = out.withColumn("report_date", F.date_format(monday, "yyyy-MM-dd"))
    if contract.lookup is not None:
        out = enrich_rates(out, rates, contract.lookup)
    return out.select(*snapshot_columns(out, contract, (ORDER_COL,) if arrival else ()))


def incomplete_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows the snapshot drops for an empty key part (for a quarantine table)."""
    parts = [normalize_key(k) for k in contract.key]
    return df.filter(~key_complete(parts))


def build_snapshot(spark: SparkSession, grid: DataFrame, contract: Contract | str,
                   rates: DataFrame | None = None, strict: bool = True, config_dir: str | None = None) -> DataFrame:
    """Grid (cells per file and row) -> snapshot: extract, then transform."""
    from snapweave.operators.resolve import extract

    contract = find_contract(spark, contract, config_dir)
    return transform(extract(grid, contract, strict=strict), contract, rates)
