"""Dirty weekly extracts derived, without randomness, from the TPC-H-style tables.

Every ``lineitem`` row becomes one extract row of its order's ISO week. The
dirt (padded numbers, numbers as ``1 234,50`` text, float artifacts in item
numbers, missing keys, currencies without a rate) follows fixed rules on the
row's own keys, so Spark and an SQL engine build the very same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.functions.dates import iso_week, iso_year
from snapweave.session import ensure_parallelism

# Fixed values of the derivation rules.
CURRENCIES = ("EUR", "USD", "GBP", "PLN")  # picked by l_suppkey % 4
PO_PREFIX, PR_PREFIX = "45", "10"
NUMBER_WIDTH = 7          # order key digits after the prefix
MATERIAL_WIDTH = 8
BLOCK_ORDERS = 100_000    # orders per extract file within one week

# Lineitem columns in the order that defines "file order" of extract rows.
ROW_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def _pad(x: Column, width: int) -> Column:
    """Zero-pad a non-negative number's text to a minimum width."""
    return F.lpad(x, F.greatest(F.length(x), F.lit(width)), "0")


def _plain_number(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _comma_number(c: Column) -> Column:
    """12345.6 -> "12 345,60": space thousands, comma decimals."""
    return F.translate(F.format_number(c, 2), ",.", " ,")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*ROW_ORDER)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # Every side here grows with the data. Orders get their customer first, so the lines are not shuffled once
    # more for it. Lines and orders meet in a shuffle join at any size: it also spreads lines that come in few
    # row groups. The other joins are left to the planner.
    ordered = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    return (
        li.join(ordered.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )


def _common(prefix: str) -> dict[str, Column]:
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    number = F.concat(F.lit(prefix), _pad(ok.cast("string"), NUMBER_WIDTH))
    item = (ln * 10).cast("string")
    qty = _plain_number(F.col("l_quantity"))
    return {
        "number": F.when(pk % 5 == 0, F.concat(F.lit(" "), number, F.lit("  "))).otherwise(number),
        "item": F.when((ok * 7 + ln) % 97 == 0, F.lit(None).cast("string"))
                 .when(sk % 11 == 0, F.concat(item, F.lit(".0")))
                 .otherwise(item),
        "material": F.when(pk % 2 == 0, _pad(pk.cast("string"), MATERIAL_WIDTH)).otherwise(pk.cast("string")),
        "quantity": F.when(pk % 2 == 0, F.replace(qty, F.lit("."), F.lit(","))).otherwise(qty),
        "plant": F.concat(F.lit("P"), ((F.col("s_nationkey") % 3 + 1) * 100).cast("string")),
        "ship_iso": F.date_format("l_shipdate", "yyyy-MM-dd"),
    }


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "report_year": iso_year("o_orderdate"),
        "report_week": iso_week("o_orderdate"),
        "_order": F.struct(*ROW_ORDER),
        "_block": (F.col("l_orderkey") / F.lit(BLOCK_ORDERS)).cast("long"),
    })


def open_po_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved but still dirty ``open_po`` rows (all fields as text)."""
    c = _common(PO_PREFIX)
    sk, ok = F.col("l_suppkey"), F.col("l_orderkey")
    price = F.col("l_extendedprice")
    currency = (
        F.when(ok % 53 == 0, F.lit(None).cast("string"))
        .when(ok % 59 == 0, F.lit("CHF"))
        .otherwise(F.element_at(F.array(*[F.lit(x) for x in CURRENCIES]), (sk % 4 + 1).cast("int")))
    )
    df = _stamp(_lines(spark, sf_dir))
    return df.select(
        c["number"].alias("po_number"),
        c["item"].alias("po_item"),
        c["material"].alias("material"),
        F.col("p_name").alias("material_description"),
        F.col("s_name").alias("supplier"),
        c["quantity"].alias("order_quantity"),
        F.when(sk % 2 == 0, _comma_number(price)).otherwise(_plain_number(price)).alias("net_price"),
        currency.alias("currency"),
        c["ship_iso"].alias("delivery_date"),
        c["plant"].alias("plant"),
        F.col("c_name").alias("requisitioner"),
        "report_year", "report_week", "_order", "_block",
    )


def all_prs_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved but still dirty ``all_prs`` rows (all fields as text)."""
    c = _common(PR_PREFIX)
    df = _stamp(_lines(spark, sf_dir))
    return df.select(
        c["number"].alias("pr_number"),
        c["item"].alias("pr_item"),
        c["material"].alias("material"),
        F.col("p_name").alias("material_description"),
        c["quantity"].alias("requested_quantity"),
        F.col("c_name").alias("requisitioner"),
        F.col("s_name").alias("responsible"),
        c["ship_iso"].alias("release_date"),
        c["plant"].alias("plant"),
        "report_year", "report_week", "_order", "_block",
    )


EXTRACTS = {"open_po": open_po_extract, "all_prs": all_prs_extract}


def extract_from_tables(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return EXTRACTS[dataset](spark, sf_dir)
