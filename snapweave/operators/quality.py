"""Data-quality checks as single-pass aggregates.

Each ``*_report`` returns a small lazy DataFrame of counts. ``table_report``
takes all rules of a table in one pass; ``enforce`` stops a job on the failing
rows of any report that says ``passed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

MAX_PCT = 0.5  # largest allowed week-over-week change in row count


class QualityError(ValueError):
    """A table broke a rule; the text holds the failing rows of the report."""


def table_report(df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = (),
                 dated: bool = False, nulls_equal: bool = True) -> DataFrame:
    """Every rule of a table in one pass: ``check, rows, bad_rows, passed``, one row a rule.

    ``unique`` columns together identify a row (with ``nulls_equal`` NULLs are a
    value like others, else rows with a NULL part are left out of this rule);
    each ``not_null`` column has a value; with ``dated`` the report date is the
    Monday of the row's week. Counts are first taken per key, so a repeated key
    is combined before the shuffle. An empty table passes.
    """
    from snapweave.functions.dates import report_monday

    bad = {f"not_null({c})": F.count_if(F.col(c).isNull()) for c in not_null}
    if dated:
        monday = report_monday(F.col("report_week"), F.col("report_year"), check=False)
        bad["report_date"] = F.count_if(~F.col("report_date").cast("date").eqNullSafe(monday))
    names = list(bad)
    counts = [F.count(F.lit(1)).alias("n"), *[bad[c].alias(f"b{i}") for i, c in enumerate(names)]]
    if unique:
        per_key = df.groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(unique)]).agg(*counts)
        repeated = F.col("n") > 1
        for i in range(0 if nulls_equal else len(unique)):
            repeated = repeated & F.col(f"k{i}").isNotNull()
        per_key = per_key.withColumn("dup", F.when(repeated, F.col("n")).otherwise(0))
        names.append(f"unique({', '.join(unique)})")
        counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *[f"b{i}" for i in range(len(bad))], "dup")]
        one = per_key.agg(*counts).withColumnRenamed("dup", f"b{len(bad)}")
    else:
        one = df.agg(*counts)
    lines = F.array(F.struct(F.lit("rows").alias("check"), F.lit(0).cast("long").alias("bad_rows")),
                    *[F.struct(F.lit(c).alias("check"), F.col(f"b{i}").cast("long").alias("bad_rows"))
                      for i, c in enumerate(names)])
    return one.select(F.col("n").cast("long").alias("rows"), F.inline(lines)).select(
        "check", "rows", "bad_rows", (F.col("bad_rows") == 0).alias("passed"))


def enforce(report: DataFrame, subject: str) -> list[Row]:
    """Run a report (a row per rule or week) and raise ``QualityError`` on rows that did not pass."""
    lines = report.collect()
    broken = [r for r in lines if not r["passed"]]
    if broken:
        said = "; ".join(", ".join(f"{k} {v}" for k, v in r.asDict().items() if k != "passed") for r in broken)
        raise QualityError(f"{subject} does not pass: {said}")
    return lines


def unique_keys_report(df: DataFrame, key_cols: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """rows, and rows that sit in a duplicate key group (every member counted).

    NULL keys group together; with ``skip_nulls`` rows with a NULL key part
    are left out (the model test flavour).
    """
    src = df
    if skip_nulls:
        for k in key_cols:
            src = src.filter(F.col(k).isNotNull())
    groups = src.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("dup_rows"),
    )


def not_null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``rows`` and ``nulls_<col>`` for every column, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def row_count_delta_report(df: DataFrame, week_cols: Sequence[str] = ("report_year", "report_week"),
                           max_pct: float = MAX_PCT) -> DataFrame:
    """Rows per week next to the previous loaded week's rows.

    The window runs over the per-week counts (one row per week), never over
    the data rows.
    """
    per_week = df.groupBy(*week_cols).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(*week_cols)
    prev = F.lag("rows").over(w)
    pct = F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(F.abs(F.col("rows") - prev) / prev)
    return per_week.select(*week_cols, "rows", prev.alias("prev_rows"), pct.alias("pct")).withColumn(
        "passed", F.col("pct") <= F.lit(max_pct))


def freshness_report(df: DataFrame, date_col: str = "report_date", expected: str | None = None,
                     week_cols: Sequence[str] = ("report_year", "report_week")) -> DataFrame:
    """Per week (or for one ``expected`` date overall): rows and rows whose
    date differs from the expected one. An empty frame fails."""
    from snapweave.functions.dates import report_monday

    if expected is not None:
        exp = F.lit(expected)
        out = df.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_if(~F.col(date_col).cast("string").eqNullSafe(exp)).alias("stale_rows"))
    else:
        exp = F.date_format(report_monday(F.col(week_cols[1]), F.col(week_cols[0])), "yyyy-MM-dd")
        out = df.groupBy(*week_cols).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col(date_col).cast("string").eqNullSafe(exp)).alias("stale_rows"))
    return out.withColumn("passed", (F.col("rows") > 0) & (F.col("stale_rows") == 0))


def date_counts(df: DataFrame, date_col: str) -> DataFrame:
    """Every date found, with its rows."""
    return df.groupBy(F.col(date_col).cast("string").alias(date_col)).agg(F.count(F.lit(1)).alias("rows"))


def relationships_report(child: DataFrame, parent: DataFrame, col: str = "currency") -> DataFrame:
    """Non-null child values without a parent row, with their row counts."""
    orphans = child.filter(F.col(col).isNotNull()).join(parent.select(col), col, "left_anti")
    return orphans.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
