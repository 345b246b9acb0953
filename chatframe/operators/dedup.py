"""Rows that were exported twice, and old ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_messages(df: DataFrame, on: Sequence[str] = ("datetime", "sender", "text"), order: Sequence[str] = ("source_file", "line_no")) -> DataFrame:
    """One row per value of on, the first by order; nulls equal each other."""
    w = Window.partitionBy(*(f"row.`{c}`" for c in on)).orderBy(*(f"row.`{c}`" for c in order))
    return df.select(F.struct("*").alias("row")).withColumn("n", F.row_number().over(w)).where("n = 1").select("row.*")


def cutoff(df: DataFrame, months: int, as_of, ts: str = "datetime") -> DataFrame:
    """Rows of the last months of 30 days before as_of; 0 keeps all, otherwise rows without time go."""
    if not months:
        return df
    return df.where(F.col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {30 * months} DAYS"))
