"""Reports over message and sample tables; all return DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.message import twelve_hour
from ..functions.pytext import bind, redact, strip

#: Total samples from which a corpus counts as usable and as good.
ENOUGH, GOOD = 3_000, 8_000


def corpus_stats(df: DataFrame) -> DataFrame:
    """One row: messages, first and last day, chats, media messages, their share in percent (null for an empty table)."""
    return df.agg(F.count("*").alias("n_messages"), F.to_date(F.min("datetime")).alias("first_day"), F.to_date(F.max("datetime")).alias("last_day"), F.countDistinct("source_file").alias("n_chats"), F.count_if(F.col("is_media")).alias("n_media"))


def your_stats(df: DataFrame, you: str) -> DataFrame:
    """One row on your messages: number, mean length, mean words, messages with emoji."""
    return df.where(F.col("sender") == you).agg(F.count("*").alias("n_messages"), F.avg("message_length").alias("mean_length"), F.avg("word_count").alias("mean_words"), F.count_if(F.col("has_emoji")).alias("n_emoji"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """column, n_messages, from the most frequent; equal counts by value; top keeps the first ones."""
    out = df.groupBy(column).agg(F.count("*").alias("n_messages")).orderBy(F.desc("n_messages"), column)
    return out.limit(top) if top else out


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """column, n_messages, percent of all rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n_messages"))
    total = df.agg(F.count("*").alias("_all"))
    return counts.join(F.broadcast(total)).select(column, "n_messages", (F.col("n_messages") * 100.0 / F.col("_all")).alias("percent"))  # total: one row


def with_bar(counts: DataFrame, width: int = 30, by: str = "n_messages") -> DataFrame:
    """counts with a bar scaled to the largest; counts is a report of few rows."""
    top = counts.agg(F.max(by).alias("_top"))
    return counts.join(F.broadcast(top)).withColumn("bar", F.repeat(F.lit("█"), F.floor(F.col(by) * width / F.col("_top")).cast("int"))).drop("_top")  # top: one row


def top_hours(df: DataFrame, k: int = 5) -> DataFrame:
    """hour, label, n_messages of the k busiest hours."""
    hours = df.where("datetime is not null").select(F.hour("datetime").alias("hour"))
    return hours.groupBy("hour").agg(F.count("*").alias("n_messages")).orderBy(F.desc("n_messages"), "hour").limit(k).select("hour", twelve_hour(F.col("hour")).alias("label"), "n_messages")


def size_verdict(splits: DataFrame) -> DataFrame:
    """n_samples of all splits and its verdict: small, usable or good."""
    n = splits.agg(F.count("*").alias("n_samples"))
    return n.withColumn("verdict", F.when(F.col("n_samples") < ENOUGH, "small").when(F.col("n_samples") < GOOD, "usable").otherwise("good"))


def recent(df: DataFrame, n: int, *ties: str) -> DataFrame:
    """The n latest rows with a datetime, from the oldest of them; null times are no rows of a timeline."""
    return df.where("datetime is not null").orderBy(F.desc("datetime"), *(F.desc(t) for t in ties)).limit(n).orderBy("datetime", *ties)


def recent_messages(df: DataFrame, n: int, *ties: str, keep: int = 24) -> DataFrame:
    """The n latest messages: shown_at (``05 Jan 13:20``), sender of at most 20 characters, preview of at most 60."""
    return recent(df, n, *ties).select(*ties, F.date_format("datetime", "dd MMM HH:mm").alias("shown_at"), F.substring("sender", 1, 20).alias("sender"), F.substring(redact(F.col("text"), keep, "[DROPPED]"), 1, 60).alias("preview"))


def cleaning_preview(df: DataFrame, cleaned: Column, n: int, *ties: str, text: str = "text", keep: int = 24) -> DataFrame:
    """The n latest rows that cleaning changes or drops, or the n latest rows if it changes none."""
    both = bind(cleaned, lambda c: F.struct(c.alias("cleaned"), (~F.col(text).eqNullSafe(c)).alias("changed")))
    rows = df.select("*", F.inline(F.array(both)))
    some = rows.agg(F.coalesce(F.max("changed"), F.lit(False)).alias("_some"))
    wanted = rows.join(F.broadcast(some)).where(F.col("changed") | ~F.col("_some"))  # some: one row
    return recent(wanted, n, *ties).select(*ties, redact(F.col(text), keep).alias("before"), redact(F.col("cleaned"), keep, "[DROPPED]").alias("after"), "changed")


def cleaning_effect(df: DataFrame, cleaned: Column, text: str = "text") -> DataFrame:
    """One row: rows, changed ones (dropped ones included) and dropped ones."""
    rows = df.select(F.inline(F.array(bind(cleaned, lambda c: F.struct(F.col(text).alias("t"), c.alias("c"))))))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("t").eqNullSafe(F.col("c"))).alias("n_changed"), F.count_if(F.col("c").isNull()).alias("n_dropped"))


def candidate_names(df: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent senders, the likely spellings of the owner's name first."""
    return value_counts(df.where(strip(F.col("sender")) != ""), "sender", k)
