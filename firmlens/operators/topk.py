"""Sorts, limits and top-k (T1-T4). A sort followed by a limit plans as
TakeOrderedAndProject: each partition keeps its own top n and only those meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(
    df: DataFrame,
    by: str,
    n: int,
    tiebreak: Sequence[str] = (),
    descending: bool = True,
    nulls_last: bool = True,
) -> DataFrame:
    """The first ``n`` rows by ``by`` (descending by default); nulls sort last, so
    they only appear when fewer than ``n`` values exist; ties by ``tiebreak`` ascending."""
    c = F.col(by)
    if descending:
        order = c.desc_nulls_last() if nulls_last else c.desc_nulls_first()
    else:
        order = c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return df.orderBy(order, *[F.col(t).asc() for t in tiebreak]).limit(n)


def history(df: DataFrame, key: str, key_value: object, order_col: str, cols: Sequence[str]) -> DataFrame:
    """One key's rows in ascending ``order_col`` order, with the chosen columns."""
    return df.where(F.col(key) == F.lit(key_value)).orderBy(order_col, *cols).select(*cols)


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """T4: distinct non-null values, ascending."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """T5: the first rows (no order implied)."""
    return df.limit(n)
