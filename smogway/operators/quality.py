"""Schema checks and keep-first / keep-last deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate_columns(df: DataFrame, required: Sequence[str], name: str = "DataFrame") -> DataFrame:
    """Fail at plan time when columns are missing; runs no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")
    return df


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    # One min_by/max_by per column instead of a window: with a single ordering column and numeric
    # payload this is a hash aggregate that combines map-side, so a hot key shrinks before the shuffle.
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    payload = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(*[pick(F.col(c), order).alias(c) for c in payload])
    return picked.select(*df.columns)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of every key in `order_by`, which must not be NULL. NULL keys form one group."""
    return _pick(df, keys, order_by, F.min_by)


def dedupe_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of every key in `order_by`, which must not be NULL. NULL keys form one group."""
    return _pick(df, keys, order_by, F.max_by)


def only_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, whose keys must be unique: a key with several rows, none of which comes first, fails the query."""
    payload = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in payload], F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("several rows for a key and no order")))
    return single.where(checked).select(*df.columns)


def upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Union of both frames with one row per key: new rows win, then the last in `order_by`.

    Without `order_by` the keys of each side are unique. Either side is reduced by itself and the old rows whose key is
    new are left out by an anti join, which finds both sides dealt out by key already.
    """
    if order_by:
        existing, new = dedupe_last(existing, keys, order_by), dedupe_last(new, keys, order_by)
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    replaced = existing.alias("old").join(new.select(*keys).alias("new"), same, "left_anti")
    return replaced.unionByName(new, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last known row of every key, e.g. the newest reading of a segment."""
    return dedupe_last(df, keys, order_by)


def distinct_readings(df: DataFrame, keys: Sequence[str] = ("timestamp", "segment_id", "velocity")) -> DataFrame:
    """Drop readings delivered twice by an at-least-once source."""
    return df.dropDuplicates(list(keys))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))
