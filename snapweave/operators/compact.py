"""One row per key: the last (or first) row after a stable sort.

The winner has row number 1 in its key. Spark limits each key to one row per
map task before the shuffle (WindowGroupLimit), so a key holding a third of
all rows sends one candidate per map task, never the whole group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Which way a key's rows are ranked so that the wanted one comes first.
ENDS = {"last": Column.desc, "first": Column.asc}


def compact_rows(df: DataFrame, key_cols: Sequence[str], sort_cols: Sequence[str] | None = None,
                 keep: str = "last", order_cols: Sequence[str] | None = None) -> DataFrame:
    """Collapse rows sharing ``key_cols`` to one.

    Rows are ranked by ``sort_cols`` (ascending, NULLs last, as a stable sort
    would place them) and then by ``order_cols``, the input order. Without an
    order column every remaining column breaks ties, which keeps the result
    deterministic. NULL keys form one group.
    """
    towards = ENDS.get(keep)
    if towards is None:
        raise ValueError(f"no such end of a group: {keep!r} (there are {', '.join(ENDS)})")
    sort = list(sort_cols or [])
    ties = order_cols if order_cols is not None else [c for c in df.columns if c not in {*key_cols, *sort}]
    ranks = [part for c in sort for part in (F.col(c).isNull(), F.col(c))] + [F.col(c) for c in ties]
    ends = [towards(r) for r in ranks or [F.lit(0)]]
    place = F.row_number().over(Window.partitionBy(*key_cols).orderBy(*ends))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")
