"""Joins, set operations and windows in the forms that the engine offers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TarnError, unsupported

JOINS = ("inner", "left", "cross", "left_semi", "left_anti")


def join(left: DataFrame, right: DataFrame, on=None, how: str = "inner") -> DataFrame:
    """Inner, left, cross, semi and anti joins.  RIGHT, FULL and LATERAL are refused; see the emulations."""
    if how == "cross":
        return left.crossJoin(right)
    if how not in JOINS:
        raise unsupported("join", f"{how} joins are not supported; use right_join or full_join", how=how)
    if on is None:
        raise TarnError("invalid_parameters", "a join needs a condition", how=how)
    return left.join(right, on, how)


def right_join(left: DataFrame, right: DataFrame, on: Column | str | list[str]) -> DataFrame:
    """A right join as a left join with its sides swapped, columns in the usual order."""
    out = right.join(left, on, "left")
    if isinstance(on, Column):
        return out.select(*(left[c] for c in left.columns), *(right[c] for c in right.columns))
    keys = [on] if isinstance(on, str) else on
    return out.select(*keys, *(left[c] for c in left.columns if c not in keys), *(right[c] for c in right.columns if c not in keys))


def full_join(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """A full join, columns of both sides in order.  Spark's own takes one shuffle of each side, where
    a left join united with an anti join would take two."""
    return left.join(right, on, "full").select(*(left[c] for c in left.columns), *(right[c] for c in right.columns))


def union(*frames: DataFrame, distinct: bool = True) -> DataFrame:
    out = reduce(DataFrame.union, frames)
    return out.distinct() if distinct else out


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def except_(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def groups_frame(df: DataFrame, value: str, order_by: list[str], partition_by: list[str], before: int, after: int, name: str) -> DataFrame:
    """Sum of ``value`` over a GROUPS frame: peers are numbered by dense_rank, which a RANGE frame then spans."""
    from pyspark.sql import Window

    base = Window.partitionBy(*partition_by)
    numbered = df.withColumn("_peer", F.dense_rank().over(base.orderBy(*order_by)).cast("long"))
    frame = base.orderBy("_peer").rangeBetween(-before, after)
    return numbered.withColumn(name, F.sum(value).over(frame)).drop("_peer")
