"""Row filters (F1-F9). Plain predicates, so Catalyst pushes them into the scan
(``PushedFilters`` on Parquet/JDBC) whenever they reach it."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import ACTIVE, POSTAL_LENGTH


def filter_active(df: DataFrame, status_col: str, active: str = ACTIVE) -> DataFrame:
    """rows whose status equals the active value (null status is dropped)."""
    return df.where(F.col(status_col) == F.lit(active))


def filter_in_list(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """rows whose value is in a (small, caller-given) list."""
    return df.where(F.col(col).isin(list(values)))


def drop_null_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows that are null in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def filter_postal(df: DataFrame, col: str, max_len: int = POSTAL_LENGTH) -> DataFrame:
    """postal code present and at most ``max_len`` characters long."""
    c = F.col(col)
    return df.where(c.isNotNull() & (F.length(c.cast("string")) <= max_len))


def filter_non_negative(df: DataFrame, col: str) -> DataFrame:
    """value ≥ 0 (null dropped)."""
    return df.where(F.col(col) >= 0)


def filter_positive(df: DataFrame, col: str) -> DataFrame:
    """value > 0 (null dropped)."""
    return df.where(F.col(col) > 0)


def filter_min(df: DataFrame, col: str, lower: object) -> DataFrame:
    """value ≥ lower (e.g. a year)."""
    return df.where(F.col(col) >= F.lit(lower))


def filter_scope(
    df: DataFrame,
    place_col: str,
    sector_col: str,
    place: str | None,
    sector: str | None = None,
    place_optional: bool = False,
) -> DataFrame:
    """F8: dashboard scope. No place → empty result (the dashboard shows nothing until a
    place is chosen); a place alone → that place; place and sector → both. With
    ``place_optional`` (the dashboard's older form) no place means every place."""
    if place is None:
        if not place_optional:
            return df.where(F.lit(False))
        return df if sector is None else df.where(F.col(sector_col) == F.lit(sector))
    cond: Column = F.col(place_col) == F.lit(place)
    if sector is not None:
        cond = cond & (F.col(sector_col) == F.lit(sector))
    return df.where(cond)


def incremental_filter(
    df: DataFrame,
    mark_col: str,
    mark: str | _dt.date | _dt.datetime | Column,
    status_col: str | None = None,
    active: str = ACTIVE,
) -> DataFrame:
    """rows at or after the high-water mark (closed lower bound, open top), optionally
    active only. ``mark`` may be a Column (e.g. a scalar sub-query over a state table)."""
    m = mark if isinstance(mark, Column) else F.lit(mark)
    cond = F.col(mark_col) >= m
    if status_col is not None:
        cond = cond & (F.col(status_col) == F.lit(active))
    return df.where(cond)
