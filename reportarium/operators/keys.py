"""Steps around keys: latest row, unique dimension, look-up, membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is pruned before the shuffle (``WindowGroupLimit``): each task
    forwards at most one row per key, so a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def evenly(df: DataFrame) -> DataFrame:
    """The small side of a join that may meet hot keys.

    A side already partitioned by the join key (by a window or an aggregate) would join
    without a shuffle of its own, and Spark splits the hot partitions of a sort-merge
    join only between two fresh shuffles. Rebalanced first, the side gets one.
    """
    return df.hint("rebalance")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key; equal stamps are decided by the other columns, so the result is stable."""
    rest = ties if ties is not None else [c for c in df.columns if c not in (*keys, stamp)]
    order = [F.col(stamp).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in rest)]
    return first_per_key(df, keys, order)


def unique_dimension(dimension: DataFrame, key: Column, columns: Sequence[str]) -> DataFrame:
    """``__key`` and ``columns`` with one row per key, so that joining cannot multiply rows."""
    slim = dimension.select(key.alias("__key"), *columns).filter("__key is not null")
    return first_per_key(slim, ["__key"], [F.col(c).asc_nulls_last() for c in columns])


def look_up(
    df: DataFrame, on: Column, dimension: DataFrame, key: Column, columns: Sequence[str]
) -> DataFrame:
    """Add ``columns`` of a dimension: one match per row, no match gives nulls.

    No broadcast hint: Spark broadcasts the dimension where its measured size allows,
    and otherwise splits the hot keys of a sort-merge join.
    """
    unique = evenly(unique_dimension(dimension, key, columns))
    return df.withColumn("__on", on).join(unique, F.col("__on") == F.col("__key"), "left").drop(
        "__on", "__key"
    )


def not_in(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the known keys.

    One anti join: the rows are made once, and of the known ones (a whole history) only
    the keys travel, once.
    """
    return df.join(known.select(*keys), list(keys), "left_anti")
