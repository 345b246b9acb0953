"""Held-out samples, generated replies and their comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.message import EMOJI_SIGN
from ..functions.pytext import redact, strip

_USER, _ASSISTANT, _END = "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_end|>"
#: The length ratio that passes.
LEAST_RATIO, MOST_RATIO = 0.6, 1.6


def user_content(text: Column) -> Column:
    """What follows the first user marker up to the next end marker, stripped; empty if a marker is missing."""
    return F.coalesce(strip(F.regexp_extract(text, r"(?s)<\|im_start\|>user\n(.*?)<\|im_end\|>", 1)), F.lit(""))


def true_reply(text: Column) -> Column:
    """What stands between the first assistant marker and the last end marker, stripped; empty if one is missing."""
    return F.coalesce(strip(F.regexp_extract(text, r"(?s)^.*?<\|im_start\|>assistant\n(.*)<\|im_end\|>", 1)), F.lit(""))


def prompt_prefix(text: Column) -> Column:
    """The record up to and with its assistant marker."""
    return F.concat(F.substring_index(text, _ASSISTANT, 1), F.lit(_ASSISTANT))


def eval_samples(samples: DataFrame, n: int | None = None, order: str | None = None, text: str = "text", raw: bool = False, keep: int = 12) -> DataFrame:
    """id, prompt, context_preview, true_preview (and context, true with raw) of samples with a context.

    n keeps the first samples in order; ids count from 0 in order and need it. Null texts are left out.
    """
    rows = samples.where(F.col(text).isNotNull())
    if n is not None:
        rows = rows.orderBy(order).limit(n) if order else rows.limit(n)
    rows = rows.withColumns({"_u": user_content(F.col(text)), "_t": true_reply(F.col(text))}).where("_u <> ''")
    ident = (F.row_number().over(Window.orderBy(order)) - 1).cast("bigint") if order and n is not None else F.monotonically_increasing_id()
    shown = [ident.alias("id"), prompt_prefix(F.col(text)).alias("prompt"), redact(F.col("_u"), keep).alias("context_preview"), redact(F.col("_t"), keep).alias("true_preview")]
    return rows.select(*shown, *([F.col("_u").alias("context"), F.col("_t").alias("true")] if raw else []), *([order] if order else []))


def generate(samples: DataFrame, generator: Callable[[list[str]], list[str]]) -> DataFrame:
    """samples with generated: the replies that generator gives to a batch of prompts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(generated=generator(pdf["prompt"].tolist()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.schema)
    return samples.mapInPandas(run, f"{schema}, generated string")


def value_or_preview(raw: Column, preview: Column) -> Column:
    """raw unless null or empty, then preview, then the empty text."""
    return F.coalesce(F.nullif(raw, F.lit("")), preview, F.lit(""))


def last_context_line(context: Column) -> Column:
    """The line before the metadata: of several lines the last but one, or the last but two if that one is in brackets
    (``...`` if there is none); a single line is itself."""
    lines = F.split(context, "\n")
    second = F.try_element_at(lines, F.lit(-2))
    return F.when(F.size(lines) < 2, context).otherwise(F.when(second.startswith("["), F.coalesce(F.try_element_at(lines, F.lit(-3)), F.lit("..."))).otherwise(second))


def eval_summary(pairs: DataFrame, true: str = "true", generated: str = "generated") -> DataFrame:
    """One row: samples, mean lengths, their ratio and whether it passes, emoji rates of both. Empty tables give zeros."""
    t, g = F.coalesce(true, F.lit("")), F.coalesce(generated, F.lit(""))
    n = F.greatest(F.count("*"), F.lit(1))
    sums = pairs.agg(
        F.count("*").alias("n_samples"), (F.coalesce(F.sum(F.length(t)), F.lit(0)) / n).alias("true_length"), (F.coalesce(F.sum(F.length(g)), F.lit(0)) / n).alias("generated_length"),
        (F.count_if(t.rlike(EMOJI_SIGN)) / n).alias("true_emoji_rate"), (F.count_if(g.rlike(EMOJI_SIGN)) / n).alias("generated_emoji_rate"),
    )
    ratio = F.col("generated_length") / F.greatest(F.col("true_length"), F.lit(1.0))
    return sums.withColumn("length_ratio", ratio).withColumn("in_band", F.col("length_ratio").between(LEAST_RATIO, MOST_RATIO))
