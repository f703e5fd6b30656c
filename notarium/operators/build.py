"""Operators for building outputs: what to write, unique names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_status(df: DataFrame, old: str, new: str) -> DataFrame:
    """Add ``status``: skipped without new content, written where nothing was, else unchanged or overwritten by digest."""
    status = F.when(F.col(new).isNull(), "skipped").when(F.col(old).isNull(), "written").when(F.col(old) == F.col(new), "unchanged").otherwise("overwritten")
    return df.withColumn("status", status)


def numbered(df: DataFrame, name: str, order: str) -> DataFrame:
    """Names with ``_2``, ``_3`` ... from the second of a name on, by order."""
    rn = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return df.withColumn("_rn", rn).withColumn(name, F.when(F.col("_rn") == 1, F.col(name)).otherwise(F.concat(name, F.lit("_"), "_rn"))).drop("_rn")


def overlay(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``new`` with each column filled from ``old`` where it is null."""
    before = old.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = new.join(before, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(c, f"_{c}")).drop(f"_{c}")
    return out
