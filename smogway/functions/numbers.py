"""Null-safe numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(x: Column) -> Column:
    """Spark ranks NaN above every number, so canonical frames carry NULL instead."""
    return F.nanvl(x, F.lit(None).cast("double"))


def without_nan(df: DataFrame, *columns: str) -> DataFrame:
    """`nan_to_null` on the named columns that are floating point."""
    fractional = [c for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in fractional}) if fractional else df


def clamp01(x: Column) -> Column:
    """Clip to [0, 1]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))
