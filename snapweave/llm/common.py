"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.session import shared_dir

ROWS_A_FILE = 65_536  # of a stored table of short rows whose size is known
BATCH_ROWS = 1000  # rows of whole texts that a task holds at once on their way to Python


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder all executors share."""
    return f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """From now on the session's tasks send ``BATCH_ROWS`` rows at once to Python, if they sent more.

    Spark's 10,000 rows of whole texts stand in the task's buffers and in its Python worker at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage with a table every executor can read, so a lost executor
    costs a re-read and never a recomputation of what came before. With ``rows``, about
    how many (short) rows ``df`` has, no more files than they fill: a file costs the
    executor that creates it a few calls to the store, and on a local one processes.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / ROWS_A_FILE)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32 of the id as text modulo ``k``; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(k)).cast("int")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` clashes (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
