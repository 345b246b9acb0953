"""Context windows of replies and their rendering as chat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import micros

#: Texts of the records.
NO_CONTEXT = "(start of conversation)"
SYSTEM_PROMPT = """You are replicating {your_name}'s WhatsApp texting style exactly.
You will receive recent conversation messages and contextual metadata.
Generate a reply that matches {your_name}'s natural texting style for this relationship.
Keep it authentic — match their typical length, tone, vocabulary, and emoji usage.
This is texting, not formal writing. Be natural."""
DAY_S = 86_400


def _column(df: DataFrame, name: str, default) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def context_windows(df: DataFrame, you: str, size: int = 5, keys: tuple[str, ...] = ("conversation_id", "source_file", "session_id"), ties: tuple[str, ...] = ("line_no",), slice_s: int = DAY_S) -> DataFrame:
    """One row per message of you: the context of the up to size messages before it in its session, and its metadata.

    The frame covers everybody's messages; only then the rows are yours. A session is cut into slices of time, and the
    last size messages of the slices before come along, so its length is no limit. keys that df lacks are left out, null
    keys are values of their own; rows without datetime are left out, null senders and texts show as ``null``. With size
    0 every context is empty.
    """
    keys = tuple(k for k in keys if k in df.columns)
    named = [F.coalesce(F.concat(F.lit("v"), F.col(k).cast("string")), F.lit("n")).alias(f"_k{i}") for i, k in enumerate(keys)]
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = df.select("*", *named, micros(F.col("datetime")).alias("_us")).where("_us is not null").withColumn("_slice", F.floor(F.col("_us") / F.lit(slice_s * 1_000_000)))
    order = ["_us", *ties]
    said = F.struct(F.coalesce("sender", F.lit("null")).alias("sender"), F.coalesce("text", F.lit("null")).alias("text"))
    if size > 0:
        inside = Window.partitionBy(*ks, "_slice").orderBy(*order)
        back = Window.partitionBy(*ks, "_slice").orderBy(*(F.desc(c) for c in order))
        tail = rows.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= size)
        ends = tail.groupBy(*ks, "_slice").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("r"), said.alias("m")))), lambda x: x.m).alias("_tail"))
        before = ends.select(*ks, "_slice", F.flatten(F.collect_list("_tail").over(Window.partitionBy(*ks).orderBy("_slice").rowsBetween(-size, -1))).alias("_carried"))
        mine = rows.withColumn("_near", F.collect_list(said).over(inside.rowsBetween(-size, -1))).where(F.col("sender") == you).join(before, [*ks, "_slice"])
        every = F.concat("_carried", "_near")
        mine = mine.withColumn("_m", F.slice(every, F.greatest(F.size(every) - size + 1, F.lit(1)), size))
    else:
        mine = rows.where(F.col("sender") == you).withColumn("_m", F.array().cast("array<struct<sender:string,text:string>>"))
    other = F.filter("_m", lambda m: m.sender != you)
    return mine.select(
        F.when(F.size("_m") == 0, NO_CONTEXT).otherwise(F.array_join(F.transform("_m", lambda m: F.concat(m.sender, F.lit(": "), m.text)), "\n")).alias("context"),
        F.col("text").alias("reply"),
        F.when(F.size(other) > 0, F.element_at(other, -1)["sender"]).otherwise("unknown").alias("recipient_name"),
        _column(df, "recipient_phone", "unknown").alias("recipient_phone"),
        _column(df, "relationship", "acquaintance").alias("relationship"),
        "datetime",
        _column(df, "hour", 12).alias("hour"),
        _column(df, "day_name", "Monday").alias("day_name"),
        _column(df, "is_weekend", False).alias("is_weekend"),
        _column(df, "timedelta_prev", 0).cast("bigint").alias("timedelta_prev"),
        _column(df, "position", "mid").alias("position"),
        _column(df, "reply_chain_depth", 0).cast("bigint").alias("reply_chain_depth"),
        _column(df, "conversation_id", "").alias("conversation_id"),
        _column(df, "source_file", "").alias("source_file"),
        *(c for c in ("msg_id",) if c in df.columns),
    )


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def chatml(you: str) -> Column:
    """The training record of a row of context_windows."""
    meta = F.concat(F.lit("[Relationship: "), _text("relationship"), F.lit(" | Hour: "), _text("hour"), F.lit(" | Day: "), _text("day_name"), F.lit(" | Since last msg: "), _text("timedelta_prev"), F.lit("s | Position: "), _text("position"), F.lit("]"))
    return F.concat(_opening(you), F.col("context"), F.lit("\n"), meta, F.lit("\n<|im_end|>\n<|im_start|>assistant\n"), _text("reply"), F.lit("<|im_end|>"))


def _opening(you: str) -> Column:
    return F.lit(f"<|im_start|>system\n{SYSTEM_PROMPT.format(your_name=you)}\n<|im_end|>\n<|im_start|>user\n")


def prompt(context: Column, relationship: Column, you: str, as_of: Column) -> Column:
    """The record up to the assistant's turn; context: array of lines, empty or null for none."""
    lines = F.when(F.coalesce(F.size(context), F.lit(0)) > 0, F.array_join(context, "\n")).otherwise(NO_CONTEXT)
    meta = F.concat(F.lit("[Relationship: "), relationship, F.lit(" | Hour: "), F.hour(as_of).cast("string"), F.lit(" | Day: "), F.date_format(as_of, "EEEE"), F.lit("]"))
    return F.concat(_opening(you), lines, F.lit("\n"), meta, F.lit("\n<|im_end|>\n<|im_start|>assistant\n"))


def append_context(context: Column, line: Column, most: int = 10) -> Column:
    """A chat's running context with one more line, of which the last most are kept."""
    longer = F.concat(context, F.array(line))
    return F.slice(longer, F.greatest(F.size(longer) - most + 1, F.lit(1)), most)
