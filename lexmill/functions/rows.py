"""Exploding computed arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(frame: DataFrame, keep: list, array: Column | str, index: str, item: str) -> DataFrame:
    """`keep`, the BIGINT position `index` and the element `item` of every array element.

    An inner explode makes the optimizer filter on the array's size first and push that filter below
    the projection that computes the array, which then runs twice. The outer form with the filter on
    its own output computes the array once."""
    rows = frame.select(*keep, F.posexplode_outer(array).alias(index, item)).where(F.col(index).isNotNull())
    return rows.withColumn(index, F.col(index).cast("bigint"))


def held(column: Column | str) -> Column:
    """The column as it is, computed where it is defined. The optimizer puts definitions into the expressions that use them,
    but not what depends on the partition; it must not do so with the argument of a Python function, since one with lambdas
    inside is not sent to Python."""
    return F.when(F.spark_partition_id() >= 0, column if isinstance(column, Column) else F.col(column))
