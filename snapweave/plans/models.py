"""Staging projections and marts over the raw snapshot tables.

raw table -> staging (typed projection, a view) -> marts (aggregates, saved
tables). Functions calling functions make the model graph; Catalyst inlines
the views and prunes what a mart does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapweave.operators.journal import Journal, weeks_condition
from snapweave.operators.upsert import PART_COLS, changed_weeks, read_stored, replace_weeks
from snapweave.session import PACKED, free_shuffles

# Money and quantity totals are summed as exact decimals (cents; rate with 4
# places), so a total never depends on how Spark partitioned the rows.
QTY_DEC, PRICE_DEC, RATE_DEC = "decimal(18,2)", "decimal(18,2)", "decimal(9,4)"


def row_id(*cols: str) -> Column:
    """``year-week-key`` surrogate; NULL if any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.col(c).cast("string"))
    return F.concat(*parts)


def stg_open_po(raw: DataFrame) -> DataFrame:
    return raw.select(
        row_id("report_year", "report_week", "key").alias("row_id"),
        "report_year", "report_week", "key", "po_number", "po_item", "material",
        "material_description", "supplier", "order_quantity", "net_price", "currency",
        "rate_to_eur", "line_value_eur",
        F.col("report_date").cast("date").alias("report_date"),
    )


def stg_all_prs(raw: DataFrame) -> DataFrame:
    return raw.select(
        row_id("report_year", "report_week", "key").alias("row_id"),
        "report_year", "report_week", "key", "pr_number", "pr_item", "material",
        "material_description", "requested_quantity", "requisitioner", "responsible",
        F.col("report_date").cast("date").alias("report_date"),
    )


def exact_value_eur() -> Column:
    return (F.col("order_quantity").try_cast(QTY_DEC) * F.col("net_price").try_cast(PRICE_DEC)
            * F.col("rate_to_eur").try_cast(RATE_DEC))


def mart_open_po_weekly(stg: DataFrame) -> DataFrame:
    """Per ISO week: report date, line count, total quantity and EUR value."""
    return stg.groupBy("report_year", "report_week").agg(
        F.max("report_date").alias("report_date"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("order_quantity").try_cast(QTY_DEC)).cast("double").alias("total_quantity"),
        F.sum(exact_value_eur()).cast("double").alias("total_value_eur"),
    )


def mart_top_suppliers(stg: DataFrame) -> DataFrame:
    """Per ISO week and supplier: line count and EUR value (NULL supplier is a group)."""
    return stg.groupBy("report_year", "report_week", "supplier").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(exact_value_eur()).cast("double").alias("value_eur"),
    )


def ranked_suppliers(mart: DataFrame) -> DataFrame:
    """Supplier mart with its place in the week: by value, NULL first, then by name."""
    order = Window.partitionBy("report_year", "report_week").orderBy(
        F.desc_nulls_first("value_eur"), F.asc_nulls_first("supplier"))
    return mart.withColumn("supplier_rank", F.row_number().over(order))


def materialize(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a model as parquet (replacing it) and return the stored table."""
    free_shuffles(df.sparkSession)
    w = df.write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "static")  # whatever the session says
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


# The stored marts: how each is built from the staging model.
MARTS = {"mart_open_po_weekly": mart_open_po_weekly, "mart_top_suppliers": mart_top_suppliers}


def refresh_mart(spark: SparkSession, table: str, mart: str, path: str) -> int:
    """Bring a stored mart up to the loads of its raw table; returns the number of weeks rebuilt.

    Only weeks touched since the mart's last refresh are read (partition pruning) and
    exchanged, under the same journal as a load: a lost refresh is finished or repeated by the next.
    """
    journal = Journal(spark, path)
    state = journal.recover()
    number, weeks = changed_weeks(spark, table, state.source if state is not None else 0)
    if not weeks:
        return 0
    raw = read_stored(spark, table).filter(weeks_condition(PART_COLS, weeks))
    replace_weeks(spark, MARTS[mart](stg_open_po(raw)), path, weeks, number)
    return len(weeks)


def publish_models(spark: SparkSession, database: str, table: str, marts: dict[str, str]) -> None:
    """Catalog entries of a database: the staging model as a view over the raw table, the marts as tables.

    The tables stay where they are stored; entries are renewed, their data never touched.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in {"raw_open_po": table, **marts}.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.stg_open_po AS {STG_OPEN_PO_SQL.format(raw=f'{database}.raw_open_po')}")


STG_OPEN_PO_SQL = """
SELECT concat(cast(report_year AS string), '-', cast(report_week AS string), '-', key) AS row_id, report_year, report_week,
       key, po_number, po_item, material, material_description, supplier, order_quantity, net_price, currency, rate_to_eur,
       line_value_eur, cast(report_date AS date) AS report_date
FROM {raw}"""


def build_models(spark: SparkSession, raw_open_po: DataFrame, raw_all_prs: DataFrame | None = None,
                 out_dir: str | None = None) -> dict[str, DataFrame]:
    """raw -> staging -> marts. With ``out_dir`` the marts are saved as tables."""
    stg = stg_open_po(raw_open_po)
    models = {"stg_open_po": stg,
              "mart_open_po_weekly": mart_open_po_weekly(stg),
              "mart_top_suppliers": mart_top_suppliers(stg)}
    if raw_all_prs is not None:
        models["stg_all_prs"] = stg_all_prs(raw_all_prs)
    if out_dir:
        for name in ("mart_open_po_weekly", "mart_top_suppliers"):
            models[name] = materialize(models[name], f"{out_dir}/{name}")
    return models
