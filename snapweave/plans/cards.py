"""Dashboard cards: four SQL queries that read only the two marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MART_COLUMNS = {"report_year", "report_week", "report_date", "line_count", "total_quantity",
                "total_value_eur", "supplier", "value_eur"}

# Latest reporting week = greatest (ISO year, ISO week), written as yyyyww.
_LATEST = "report_year * 100 + report_week = (SELECT max(report_year * 100 + report_week) FROM {mart})"

CARDS = {
    "weekly_open_value": (
        "weekly",
        "SELECT report_year, report_week, total_value_eur FROM {mart} ORDER BY report_year, report_week",
    ),
    "weekly_line_count": (
        "weekly",
        "SELECT report_year, report_week, line_count FROM {mart} ORDER BY report_year, report_week",
    ),
    "kpi_latest_week": (
        "weekly",
        "SELECT report_year, report_week, line_count, total_quantity, total_value_eur FROM {mart} "
        "WHERE " + _LATEST,
    ),
    # The warehouse ranked NULL values first on DESC; that is kept explicitly.
    "top_suppliers_latest": (
        "suppliers",
        "SELECT supplier, value_eur FROM {mart} WHERE " + _LATEST
        + " ORDER BY value_eur DESC NULLS FIRST, supplier LIMIT 10",
    ),
}


def run_card(spark: SparkSession, name: str, weekly: DataFrame, suppliers: DataFrame) -> DataFrame:
    which, sql = CARDS[name]
    return spark.sql(sql, mart=weekly if which == "weekly" else suppliers)


def check_card_contract(spark: SparkSession, weekly: DataFrame, suppliers: DataFrame) -> dict[str, list[str]]:
    """Analyze every card; return its output columns. Fails if a card reads
    a column the marts do not have."""
    out = {}
    for name in CARDS:
        out[name] = run_card(spark, name, weekly, suppliers).columns
        for col in out[name]:
            if col not in MART_COLUMNS:
                raise ValueError(f"card {name} returns {col!r}, not a mart column")
    return out
