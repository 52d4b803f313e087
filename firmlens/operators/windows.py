"""Window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_col: str,
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """The row with the latest ``order_col`` per key; keys whose dates are all null are
    dropped; ties go to the first row under ``tiebreak``, then to the greatest row by the other
    columns in order, so that a retried task chooses alike.

    ``row_number() == 1`` is planned with a partial WindowGroupLimit before the shuffle,
    so each input partition sends at most one row per key: a hot key does not pull its
    whole group into one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kinds = (ArrayType, MapType, StructType, VariantType)
    rest = [F.col(f"`{f.name}`").desc() for f in df.schema if f.name not in (*keys, order_col) and not isinstance(f.dataType, kinds)]
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc(), *tiebreak, *rest)
    return (
        df.where(F.col(order_col).isNotNull())
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__rn")
    )
