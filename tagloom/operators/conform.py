"""Conversion of loosely typed rows to a schema, and the strict check before a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A frame does not have the columns or types of its table."""


def _convert(field: T.StructField, source: T.DataType) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.IntegerType) and not isinstance(source, T.IntegerType):
        # By way of decimal, so that a fraction is cut off instead of failing.
        column = column.try_cast("decimal(38,10)")
    return column.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, lost: str | None = "values_lost") -> DataFrame:
    """``df`` in the names, order and types of ``schema``.

    A value that does not convert becomes null; ``lost`` names a column with the number
    of such values in the row. Columns that ``df`` does not have are null.
    """
    present = {name.lower(): field.dataType for name, field in zip(df.columns, df.schema)}
    converted: list[Column] = []
    losses: list[Column] = []
    for field in schema:
        source = present.get(field.name.lower())
        if source is None:
            converted.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = _convert(field, source)
        converted.append(value.alias(field.name))
        if source != field.dataType:
            losses.append((F.col(field.name).isNotNull() & value.isNull()).cast("int"))
    if lost is not None:
        converted.append(sum(losses, F.lit(0)).alias(lost))
    return df.select(*converted)


def _given(df: DataFrame, schema: T.StructType) -> dict[str, T.DataType]:
    """The columns of ``schema`` that ``df`` has, with the types they have there."""
    present = {name.lower(): field.dataType for name, field in zip(df.columns, df.schema)}
    return {field.name: present[field.name.lower()] for field in schema if field.name.lower() in present}


def loss_counts(df: DataFrame, schema: T.StructType) -> list[Column]:
    """Aggregates ``given_<column>`` and ``lost_<column>`` for each column of ``schema`` that ``df`` has."""
    counts: list[Column] = []
    for name, source in _given(df, schema).items():
        given = F.col(name).isNotNull()
        kept = _convert(schema[name], source).isNotNull()
        counts.append(F.count_if(given).alias(f"given_{name}"))
        counts.append(F.count_if(given & ~kept).alias(f"lost_{name}"))
    return counts


def conversion_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema`` present in ``df``: values given and values lost, in one pass."""
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"given_{name}").alias("values_given"),
            F.col(f"lost_{name}").alias("values_lost"),
        )
        for name in _given(df, schema)
    ]
    return df.agg(*loss_counts(df, schema)).select(F.inline(F.array(*rows)))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the column order of ``schema``; raises if a name or type differs.

    ``DataFrame.to`` alone would fill missing columns with null and narrow numbers.
    """
    found = {field.name: field.dataType for field in df.schema}
    wanted = {field.name: field.dataType for field in schema}
    problems = [f"missing {name}" for name in wanted if name not in found]
    problems += [f"unknown {name}" for name in found if name not in wanted]
    problems += [
        f"{name} is {found[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in wanted.items()
        if name in found and found[name].simpleString() != kind.simpleString()
    ]
    if len(found) != len(df.columns):
        problems.append("duplicate column names")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.to(schema)


def merge_versions(older: DataFrame, newer: DataFrame) -> DataFrame:
    """All rows of both; a column that only one has is null in the rows of the other."""
    return older.unionByName(newer, allowMissingColumns=True)
