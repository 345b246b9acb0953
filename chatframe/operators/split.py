"""Seeded shuffle and stratified split with exact counts per stratum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import carried

TRAIN, VAL, LEAST, SEED, BUCKETS = 0.85, 0.10, 10, 42, 4096


def reply_length(df: DataFrame, least: int = 2, most: int = 500, reply: str = "reply") -> DataFrame:
    """Rows whose reply has least to most characters, both included; null replies are dropped."""
    return df.where(F.length(reply).between(least, most))


def shuffled(df: DataFrame, *key: str, seed: int = SEED) -> DataFrame:
    """df in an order that depends only on key and seed."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key)


def stratified_split(df: DataFrame, stratum: str, *key: str, train: float = TRAIN, val: float = VAL, least: int = LEAST, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """df with split: of n rows of a stratum max(1, floor(n * (1 - train - val))) test, max(1, floor(n * val)) val, the
    rest train; all train below least rows.

    Rows are ranked by a hash of key and seed. The rank is exact without sorting a stratum in one task: rows are ranked in
    hash buckets, and a histogram of the buckets gives the rank at which each begins. A null stratum is one of its own;
    rows with equal keys take neighbouring ranks.
    """
    h = F.xxhash64(*key, F.lit(seed))
    ranks = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]
    rows = df.select(carried(df, "split"), *ranks, F.coalesce(F.concat(F.lit("v"), F.col(stratum)), F.lit("n")).alias("_s"), h.alias("_h"), F.pmod(h, F.lit(buckets)).cast("int").alias("_b"))
    hist = rows.groupBy("_s", "_b").agg(F.count("*").alias("_m"))
    w = Window.partitionBy("_s")
    starts = hist.select("_s", "_b", F.coalesce(F.sum("_m").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_r0"), F.sum("_m").over(w).alias("_n"))
    rank = F.col("_r0") + F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", *(f"_k{i}" for i in range(len(key)))))
    n = F.col("_n").cast("double")
    n_test = F.greatest(F.lit(1), F.floor(n * F.lit(1 - train - val)).cast("int"))
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(val)).cast("int"))
    ranked = rows.join(starts, ["_s", "_b"]).withColumn("_r", rank)
    split = F.when(F.col("_n") < least, "train").when(F.col("_r") <= n_test, "test").when(F.col("_r") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn("split", split).select("_row.*", "split")
