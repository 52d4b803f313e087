"""Aggregations.

Conventions shared by every function (they reproduce the dashboard's pandas semantics):
null group keys are dropped before grouping; a sum over only nulls is 0 and a mean over
only nulls is null; money is summed as an exact decimal so results do not depend on the
order in which partial sums meet; ties in rankings are broken by the key, ascending.
All of these plan as partial (map-side) + final aggregation, so a hot key costs one
partial row per input partition, never a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import HISTOGRAM_EDGES
from ..functions.scalars import money, money_mean, money_sum
from .filters import filter_positive


def _not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """A1: the distinct non-null values of a key column."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: distinct rows over a projection (nulls compare equal, as in drop_duplicates)."""
    return df.select(*cols).dropDuplicates()


def count_distinct(df: DataFrame, key: str, out: str = "n_distinct") -> DataFrame:
    """A3: number of distinct non-null values (one row)."""
    return df.agg(F.countDistinct(key).alias(out))


def top_k_counts(df: DataFrame, col: str, k: int | None, out: str = "count") -> DataFrame:
    """A4: frequency table of a column, most frequent first, nulls excluded; ``k=None``
    keeps every value. Ties: value ascending."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
    ranked = counts.orderBy(F.col(out).desc(), F.col(col).asc())
    return ranked.limit(k) if k is not None else ranked


def sum_by_keys(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """A5: exact sum of ``value`` per key tuple; null keys dropped; all-null groups give 0."""
    return (
        df.where(_not_null(keys))
        .groupBy(*keys)
        .agg(F.coalesce(money_sum(value), F.lit(0.0)).alias(out or value))
    )


def count_distinct_by(df: DataFrame, keys: Sequence[str], distinct_col: str, out: str) -> DataFrame:
    """Number of distinct ``distinct_col`` values per key tuple (null keys dropped)."""
    return df.where(_not_null(keys)).groupBy(*keys).agg(F.countDistinct(distinct_col).alias(out))


def mean_by(df: DataFrame, group: str, value: str, out: str | None = None) -> DataFrame:
    """Mean of the non-null values per group (null groups dropped)."""
    return (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group)
        .agg(money_mean(value).alias(out or value))
    )


def revenue_by_group(
    rows: DataFrame,
    amounts: DataFrame,
    group: str,
    key: str = "siren",
    value: str = "chiffre_d_affaires",
    out: str | None = None,
) -> DataFrame:
    """A10: Σ amount per group where every row of ``rows`` counts each amount of its key
    (a row ⟕ amounts join, then a sum per group), largest first; groups without amounts 0.

    Computed without the one-to-many join: rows are counted per (group, key) and amounts
    summed per key, both map-side combined; the join then meets one row per key on each
    side and the per-group total is Σ count × sum (exact decimals).
    """
    out = out or value
    per_pair = rows.where(F.col(group).isNotNull()).groupBy(group, key).agg(F.count(F.lit(1)).alias("__n"))
    per_key = amounts.groupBy(key).agg(F.sum(money(value)).alias("__s"))
    joined = per_pair.join(per_key, on=key, how="left")
    total = F.sum(F.col("__n") * F.col("__s"))
    res = joined.groupBy(group).agg(F.coalesce(total.cast("double"), F.lit(0.0)).alias(out))
    return res.orderBy(F.col(out).desc(), F.col(group).asc())


def log_histogram(df: DataFrame, value: str, edges: int = HISTOGRAM_EDGES) -> DataFrame:
    """Histogram of the positive values over ``edges`` log-spaced edges from the
    smallest to the largest value (``edges - 1`` bins, empty bins included with 0).

    Bin i covers [10^(lo + i·w), 10^(lo + (i+1)·w)) with w = (hi - lo) / (edges - 1); the
    largest value is clamped into the last bin; with a single distinct value everything
    falls in bin 0. Two passes: one aggregate for lo/hi (two numbers brought to the
    driver), then one grouped count on the bin index; bins come from a range, no cross join.
    """
    bins = edges - 1
    pos = filter_positive(df.select(F.col(value).alias("v")), "v")
    b = pos.agg(F.log10(F.min("v")).alias("lo"), F.log10(F.max("v")).alias("hi")).first()
    spark = df.sparkSession
    if b is None or b["lo"] is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n bigint")
    lo, hi = F.lit(b["lo"]), F.lit(b["hi"])
    width = (hi - lo) / F.lit(bins)
    idx = F.when(hi > lo, F.least(F.lit(bins - 1), F.floor((F.log10("v") - lo) / width))).otherwise(F.lit(0))
    counts = pos.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, on="bin", how="left").select(
        "bin",
        F.pow(F.lit(10.0), lo + F.col("bin") * width).alias("lower"),
        F.pow(F.lit(10.0), lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"),
    )


def pivot_wide(
    df: DataFrame, index: str, columns: str, value: str, values: Sequence[str], fill: object = 0, unlisted: str | None = None
) -> DataFrame:
    """Long → wide, one column per listed value (the caller gives the bounded value
    domain, so no pass over the data discovers it); gaps become ``fill``. ``unlisted`` names a
    column that counts the rows of other (or null) values, which the wide form cannot show."""
    listed = [F.coalesce(F.max(F.when(F.col(columns) == v, F.col(value))), F.lit(fill)).alias(str(v)) for v in values]
    if unlisted is not None:
        known = F.coalesce(F.col(columns).isin(list(values)), F.lit(False))
        listed.append(F.count(F.when(~known, 1)).alias(unlisted))
    return df.groupBy(index).agg(*listed)


def non_null_counts(df: DataFrame) -> DataFrame:
    """Non-null count of every column, in one pass (one row, same column names)."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Number of rows (one row)."""
    return df.agg(F.count(F.lit(1)).alias(out))
