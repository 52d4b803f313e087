"""Joins (J1-J10).

Every join here is an equi-join on a key and the physical strategy is left to the
planner: a side is broadcast only when its size is known to be under
``spark.sql.autoBroadcastJoinThreshold`` — from file statistics at planning time, or from
the actual shuffle output under adaptive execution — and otherwise joined by shuffle.
Explicit ``broadcast()`` is used only for frames bounded by construction (a ``limit``).
The right side of a semi join is reduced to its distinct keys first, so a key that holds a
third of its rows costs one row per input partition.
One-to-many chains are never expanded into all pairs: the many side is aggregated per
key first (``join_chain_left``), which gives the same totals without the fan-out rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import MISSING
from ..functions.scalars import money

def join_inner_key(left: DataFrame, right: DataFrame, key: str | Sequence[str] = "siren") -> DataFrame:
    """Inner join on the shared key column(s); the key appears once."""
    return left.join(right, on=key if isinstance(key, str) else list(key), how="inner")


def join_left_parent(
    child: DataFrame, parent: DataFrame, key: str = "siren", parent_cols: Sequence[str] | None = None
) -> DataFrame:
    """Every child row with the chosen parent columns (null when no parent)."""
    cols = [key] + [c for c in (parent_cols or parent.columns) if c != key]
    return child.join(parent.select(*cols), on=key, how="left")


def join_left_parent_salted(
    child: DataFrame,
    parent: DataFrame,
    key: str = "siren",
    parent_cols: Sequence[str] | None = None,
    buckets: int = 16,
    hot_fraction: float = 0.001,
) -> DataFrame:
    """J2 for a child side with hot keys, when adaptive skew handling is not available.

    Keys holding more than ``hot_fraction`` of the child rows are hot; there are at most
    ``1 / hot_fraction`` of them, so that key list has a proven size bound and is broadcast.
    A hot key's child rows are spread over ``buckets`` salts (a hash of the row, so a retried
    task salts the same way) and its single parent row is replicated once per salt; every
    other key keeps salt 0. The shuffle join then runs on (key, salt): a key holding a third
    of the rows is processed by ``buckets`` tasks instead of one. Same rows as
    ``join_left_parent``.
    """
    cols = [key] + [c for c in (parent_cols or parent.columns) if c != key]
    total = child.select(F.count(F.lit(1))).scalar()
    hot = (
        child.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > total * F.lit(hot_fraction))
        .select(key, F.lit(True).alias("__hot"))
    )
    hot = F.broadcast(hot)  # at most 1 / hot_fraction keys
    salted_child = child.join(hot, on=key, how="left").withColumn(
        "__salt",
        # a null key meets no parent: its rows may go anywhere
        F.when(F.col("__hot") | F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]), F.lit(buckets)))
        .otherwise(F.lit(0).cast("bigint")),
    ).drop("__hot")
    salted_parent = parent.select(*cols).join(hot, on=key, how="left").withColumn(
        "__salt",
        F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint")))
                  .otherwise(F.array(F.lit(0).cast("bigint")))),
    ).drop("__hot")
    return salted_child.join(salted_parent, on=[key, "__salt"], how="left").drop("__salt")


def join_label_lookup(
    df: DataFrame,
    labels: DataFrame,
    left_col: str,
    code_col: str = "code",
    label_cols: Mapping[str, str] | Sequence[str] | None = None,
    keep_code_as: str | None = None,
) -> DataFrame:
    """Left lookup of labels by a differently named code column.

    Null codes match a null dictionary code (null-safe equality), as a pandas merge does.
    ``label_cols`` maps dictionary columns to output names (default: all but the code).
    A dictionary is small and read from files, so the planner broadcasts it by its size.
    """
    if label_cols is None:
        label_cols = [c for c in labels.columns if c != code_col]
    mapping = dict(label_cols) if isinstance(label_cols, Mapping) else {c: c for c in label_cols}
    tmp = "__label_code"
    lab = labels.select(
        F.col(code_col).alias(tmp), *[F.col(src).alias(out) for src, out in mapping.items()]
    )
    out = df.join(lab, df[left_col].eqNullSafe(lab[tmp]), "left")
    if keep_code_as:
        return out.withColumnRenamed(tmp, keep_code_as)
    return out.drop(tmp)


def join_chain_left(
    base: DataFrame,
    parent: DataFrame,
    detail: DataFrame,
    key: str = "siren",
    parent_cols: Sequence[str] | None = None,
    detail_value: str = "chiffre_d_affaires",
    prefix: str = "detail",
    salt_buckets: int | None = None,
) -> DataFrame:
    """Base ⟕ parent ⟕ detail on ``key`` where both right sides may hold many rows per key.

    A literal chain emits every (base row × detail row) pair of a key — quadratic on a hot
    key. Instead the detail side is aggregated per key first and attached to each base row:
    ``{prefix}_rows`` (how many chained rows this base row stands for; 1 when no detail
    row, as a left join keeps the row), ``{prefix}_sum`` (exact sum of the value, null
    when all null) and ``{prefix}_count`` (non-null values). Any additive statistic over the
    chained rows (sum, count, mean) is a sum of these per-row figures.

    The parent columns and the detail aggregates are first combined per key (a full join of
    two per-key frames), so the large base side is shuffled once, by one join. With
    ``salt_buckets`` that join salts hot keys (``join_left_parent_salted``).
    """
    cols = [c for c in (parent_cols or parent.columns) if c != key]
    per_key = detail.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.sum(money(detail_value)).alias(f"{prefix}_sum"),
        F.count(detail_value).alias(f"{prefix}_count"),
    )
    keyed = parent.select(key, *cols).join(per_key, on=key, how="full")
    if salt_buckets:
        out = join_left_parent_salted(base, keyed, key, buckets=salt_buckets)
    else:
        out = join_left_parent(base, keyed, key)
    return out.withColumns({
        f"{prefix}_rows": F.coalesce(F.col(f"{prefix}_rows"), F.lit(1).cast("bigint")),
        f"{prefix}_count": F.coalesce(F.col(f"{prefix}_count"), F.lit(0).cast("bigint")),
    })


def semi_join_keys(df: DataFrame, keys: DataFrame, key: str = "siren", keys_col: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``keys`` — a semi join, nothing collected to the driver.
    Duplicated keys on the right do not duplicate rows; an empty key set gives no rows."""
    k = keys.select(F.col(keys_col or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(k, on=key, how="left_semi")


def restrict_to(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Keep the rows of a series whose member is in a (top-N) frame. ``members`` is
    bounded by construction (a limit), so it is broadcast."""
    return df.join(F.broadcast(members.select(key)), on=key, how="left_semi")


def period_over_period(
    series: DataFrame,
    key: str,
    period: str,
    value: str,
    periods_back: int,
    suffixes: tuple[str, str] = ("_recent", "_past"),
    reuse: bool = True,
) -> DataFrame:
    """J7 (+A15): each key's value in the latest period next to its value ``periods_back``
    periods earlier (null when absent). The latest period is a scalar sub-query — one
    number computed once, no cross join and no collect. The series feeds three branches
    (latest, recent, past); with ``reuse`` it is computed once and materialized first
    (pass ``False`` when it already is)."""
    if reuse:
        from ..session import materialize

        series = materialize(series)
    latest = series.select(F.max(period)).scalar()
    rs, ps = suffixes
    recent = series.where(F.col(period) == latest).select(
        key, F.col(period).alias(period + rs), F.col(value).alias(value + rs)
    )
    past = series.where(F.col(period) == latest - F.lit(periods_back)).select(
        key, F.col(period).alias(period + ps), F.col(value).alias(value + ps)
    )
    return recent.join(past, on=key, how="left")


def lookup_default(
    df: DataFrame,
    labels: DataFrame,
    left_col: str,
    out: str,
    code_col: str = "code",
    label_col: str = "libelle",
    default: str = MISSING,
) -> DataFrame:
    """Label of a code, or ``default`` when the code has no label (or is null)."""
    joined = join_label_lookup(df, labels, left_col, code_col, {label_col: out})
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def labels_in_use(
    labels: DataFrame, used: DataFrame, used_col: str, code_col: str = "code", label_col: str = "libelle"
) -> DataFrame:
    """J9 (+T4): dictionary entries whose code is used, de-duplicated, sorted by code."""
    in_use = used.select(F.col(used_col).alias(code_col)).where(F.col(code_col).isNotNull()).distinct()
    return (
        labels.join(in_use, on=code_col, how="left_semi")
        .select(code_col, label_col)
        .distinct()
        .orderBy(code_col, label_col)
    )


def region_metric(
    features: DataFrame,
    counts: DataFrame,
    feature_name: str,
    count_name: str,
    metric: str,
    normalize: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Each region feature with its metric, matched on a normalised name; features
    without data get 0. ``counts`` holds one row per (already normalised) name."""
    f = features
    if normalize is not None:
        f = f.withColumn(feature_name, normalize(F.col(feature_name)))
    c = counts.select(F.col(count_name).alias("__name"), F.col(metric))
    out = f.join(c, f[feature_name] == c["__name"], "left").drop("__name")
    return out.withColumn(metric, F.coalesce(F.col(metric), F.lit(0).cast("bigint")))
