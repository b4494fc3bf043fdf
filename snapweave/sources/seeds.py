"""Reference ("seed") tables. Only the FX rates are ever joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATES_SCHEMA = "currency STRING, rate_to_eur DOUBLE"

# Rate of one unit of the currency in EUR.
RATES = [("EUR", 1.00), ("USD", 0.92), ("GBP", 1.17), ("PLN", 0.23)]


class SeedError(ValueError):
    pass


def default_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATES, RATES_SCHEMA)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system (works for s3a://, hdfs://, file:)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # no JVM handle (Spark Connect): ask the data source
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except Exception:
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def load_rates(spark: SparkSession, path: str | None = None, validate: bool = True) -> DataFrame | None:
    """Rates from a CSV with a header row; an absent file means no enrichment (None).

    Without a path the built-in seed is used. The lookup must have one non-null
    row per currency, otherwise the left join would multiply snapshot rows.
    """
    if path is None:
        return default_rates(spark)  # fixed values above: one row per currency
    if not path_exists(spark, path):
        return None
    rates = spark.read.schema(RATES_SCHEMA).option("header", True).csv(path)
    if validate:
        bad = rates.agg(
            F.count_if(F.col("currency").isNull()).alias("nulls"),
            (F.count("*") - F.count_distinct("currency")).alias("dups"),
        ).first()
        if bad["nulls"] or bad["dups"]:
            raise SeedError(f"rates must have unique non-null currencies: {bad.asDict()}")
    return rates
