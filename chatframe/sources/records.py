"""Stage tables, JSON Lines, evaluation records and word lists; writers and the purge of a work folder."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import ENGLISH_WORDS, NSFW_WORDS
from ..schema import EVALUATION, SAMPLE


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table; timestamps of nanoseconds, as other writers store them, become timestamp_ntz of microseconds."""
    old = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018  resolved while the setting holds
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", old)
    if dict(df.dtypes).get("datetime") == "bigint":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        df = df.withColumn("datetime", F.timestamp_add("MICROSECOND", F.floor(F.col("datetime") / 1000), epoch))
    return df


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """text of each JSON object, one per line."""
    return spark.read.schema(SAMPLE).json(path)


def read_splits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """text, split of several files of samples; each must exist."""
    out = None
    for split, path in paths.items():
        part = read_samples(spark, path).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no splits")
    return out


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """split (the name of the file or of its folder, without suffix), n_lines."""
    name = F.regexp_extract("_metadata.file_path", r"/([^/]+?)\.jsonl(?:/[^/]*)?$", 1)
    return spark.read.text(path, recursiveFileLookup=True).select(name.alias("split")).groupBy("split").agg(F.count("*").alias("n_lines"))


def write_samples(df: DataFrame, path: str, text: str = "text", files: int | None = None) -> bool:
    """JSON Lines of one column, characters as they are; nothing is written for an empty table. files: at most so many."""
    rows = df.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    if rows.isEmpty():
        return False
    (rows.coalesce(files) if files else rows).write.mode("overwrite").json(path)
    return True


def write_splits(df: DataFrame, folder: str, names: tuple[str, ...] = ("train", "val", "test"), files: int | None = None) -> dict[str, bool]:
    return {s: write_samples(df.where(F.col("split") == s), os.path.join(folder, f"{s}.jsonl"), files=files) for s in names}


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation records of a JSON array; columns that a file lacks are null."""
    return spark.read.option("multiLine", True).schema(EVALUATION).json(path)


def write_evaluation(df: DataFrame, path: str, most: int = 100_000) -> None:
    """A JSON array for people, written by the driver; refused beyond most records, which belong in JSON Lines."""
    rows = df.toJSON().take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} records")
    with open(path, "w", encoding="utf-8") as f:
        json.dump([json.loads(r) for r in rows], f, ensure_ascii=False, indent=2)


def read_words(path: str | None, default: tuple[str, ...] = tuple(ENGLISH_WORDS.split())) -> tuple[str, ...]:
    """Lower-case words of a text file in order, or default (the built-in English words) if there is none."""
    if not path or not os.path.exists(path):
        return default
    with open(path, encoding="utf-8") as f:
        return tuple(dict.fromkeys(f.read().lower().split()))


def read_word_lists(path: str | None, default: dict[str, tuple[str, ...]] | None = None) -> dict[str, tuple[str, ...]]:
    """Words by bucket of a JSON object, stripped, lower case, blank ones dropped; default (the built-in buckets) if there
    is no file."""
    if not path or not os.path.exists(path):
        return {k: tuple(v.split()) for k, v in NSFW_WORDS.items()} if default is None else default
    with open(path, encoding="utf-8") as f:
        return {k: tuple(dict.fromkeys(str(w).strip().lower() for w in ws if str(w).strip())) for k, ws in json.load(f).items()}


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row: n_files, n_bytes below path, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))


def purge(spark: SparkSession, folders: list[str], keep: tuple[str, ...] = (".gitkeep",), dry_run: bool = True, confirm=lambda n_bytes: False) -> int:
    """Delete what is in folders but names in keep, and make them anew; the bytes found. confirm sees them first."""
    jvm = spark._jvm.org.apache.hadoop.fs
    total, doomed = 0, []
    for folder in folders:
        at = jvm.Path(folder)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(at):
            for s in fs.listStatus(at):
                if s.getPath().getName() not in keep:
                    total += fs.getContentSummary(s.getPath()).getLength()
                    doomed.append((fs, s.getPath()))
    if not dry_run and confirm(total):
        for fs, p in doomed:
            fs.delete(p, True)
        for folder in folders:
            at = jvm.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return total
