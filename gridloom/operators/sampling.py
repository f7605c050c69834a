"""Samples that every run draws alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_class(frame: DataFrame, label: str, key: Column, n: int) -> DataFrame:
    """``n`` rows of each class, by the smallest keys."""
    return frame.withColumn("_k", F.row_number().over(Window.partitionBy(label).orderBy(key))).where(F.col("_k") <= n).drop("_k")


def class_rates(frame: DataFrame, label: str, wanted: int) -> DataFrame:
    """Rows of each class and the share that gives ``wanted`` of the rarest class's size at most, the same for all."""
    counts = frame.groupBy(label).agg(F.count("*").alias("n"))
    low = counts.agg(F.least(F.min("n"), F.lit(wanted)).alias("needed"))
    return counts.crossJoin(F.broadcast(low)).withColumn("rate", F.col("needed") / F.col("n"))  # one row is broadcast


def decimated(grid: DataFrame, factor: int) -> DataFrame:
    """Every ``factor``-th row and column, counted anew."""
    keep = (F.col("row") % factor == 0) & (F.col("col") % factor == 0)
    return grid.where(keep).withColumn("row", F.expr(f"cast(row div {factor} as int)")).withColumn("col", F.expr(f"cast(col div {factor} as int)"))
