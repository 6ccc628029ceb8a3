"""Gapless numbering inside groups of any size, without a group ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one numbering unit; the number of units grows with the input.
ROWS_PER_UNIT = 50_000


def numbered(df: DataFrame, groups: list[str], key: Column, name: str, rows: int, by: list[str]) -> DataFrame:
    """Add ``name``: 0, 1, ... inside each of ``groups``, gapless.

    A group is cut into units by a hash of ``key``; rows are numbered inside their unit (in
    the order of ``by``) and shifted by the counts of the units before. Only the counts, a
    row for each unit, come together. ``rows`` is about how many rows there are, at best the
    exact count; it fixes the number of units and no result depends on its being right.
    """
    units = max(8, -(-rows // ROWS_PER_UNIT))
    cut = df.withColumn("_unit", F.pmod(F.xxhash64(key), F.lit(units)).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*groups, "_unit").agg(F.count("*").alias("_count"))
    shifts = counts.select(*groups, "_unit", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*groups, "_unit").orderBy(*by)
    return (
        cut.withColumn("_place", F.row_number().over(inside) - 1)
        .join(shifts, [*groups, "_unit"])
        .withColumn(name, (F.col("_shift") + F.col("_place")).cast("bigint"))
        .drop("_unit", "_shift", "_place")
    )
