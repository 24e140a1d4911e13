"""Counts over every combination of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cube(rows: DataFrame, *by: str, **distinct: Column) -> DataFrame:
    """(by, level, rows, distinct): for each set of the columns, its groups with their rows and different values; in one aggregation.

    level tells which columns a row is summed over, a bit for each from the last: a null of the column itself has its bit at 0.  Null values are not counted as different ones.
    Rows are combined by group and value before they are shuffled, so a popular group is spread by its values.
    """
    counts = [F.count_distinct(c).alias(n) for n, c in distinct.items()]
    return rows.cube(*by).agg(F.grouping_id().alias("level"), F.count("*").alias("rows"), *counts)
