"""Column profiles, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``column_name, rows, nulls``."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col("__rows").alias("rows"), F.col(name).alias("nulls"))
        for name in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def describe(df: DataFrame) -> DataFrame:
    """Rows ``column_name, n, mean, stddev, min, max`` for numeric and string columns.

    Minimum and maximum are text; mean and deviation of a string column count the values
    that are numbers. Columns of other types are left out.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType))]
    measures: list[Column] = []
    rows: list[Column] = []
    for name in names:
        number = F.col(name).try_cast("double")
        measures += [
            F.count(name).alias(f"{name}_n"),
            F.avg(number).alias(f"{name}_mean"),
            F.stddev_samp(number).alias(f"{name}_stddev"),
            F.min(name).cast("string").alias(f"{name}_min"),
            F.max(name).cast("string").alias(f"{name}_max"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                *[F.col(f"{name}_{part}").alias(part) for part in ("n", "mean", "stddev", "min", "max")],
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row with the rows and the distinct values of each column."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(F.count("*").alias("rows"), *[count(name).alias(f"distinct_{name}") for name in columns])
