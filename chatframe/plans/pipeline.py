"""The stages from exports to split samples as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import clean_messages
from ..functions.message import calendar_features, conversation_id, message_features
from ..operators.contacts import Contacts, tag_relationships
from ..operators.contexts import chatml, context_windows
from ..operators.dedup import cutoff
from ..operators.ordered import order_features
from ..operators.split import reply_length, stratified_split
from ..schema import Settings
from ..sources.exports import parse_exports
from ..sources.records import read_word_lists, read_words, write_splits, write_stage


def enrich(df: DataFrame, settings: Settings, contacts: Contacts | None = None) -> DataFrame:
    """All features of cleaned messages; relationships only with contacts."""
    out = order_features(calendar_features(df), settings.you, settings.scope, settings.gap_s, settings.ghost_s)
    out = message_features(out.withColumn("conversation_id", conversation_id(F.col("source_file"))))
    return tag_relationships(out, contacts) if contacts else out


def samples(enriched: DataFrame, settings: Settings) -> DataFrame:
    """Context windows of replies of allowed length, rendered and split."""
    windows = reply_length(context_windows(enriched, settings.you, settings.context_size), settings.min_reply, settings.max_reply)
    key = [c for c in ("conversation_id", "source_file", "datetime", "context", "reply") if c in windows.columns]
    return stratified_split(windows.withColumn("text", chatml(settings.you)), "relationship", *key)


@dataclass
class Pipeline:
    """parse, clean, features, contexts and splits; nothing runs before an action."""

    spark: SparkSession
    settings: Settings = Settings()
    contacts: Contacts | None = None

    def parse(self, path: str, as_of=None) -> DataFrame:
        """Messages of the last cutoff_months before as_of, by default now."""
        return cutoff(parse_exports(self.spark, path, check=False), self.settings.cutoff_months, as_of or datetime.now())

    def clean(self, parsed: DataFrame) -> DataFrame:
        s = self.settings
        return clean_messages(parsed, devanagari=s.remove_devanagari, english=s.remove_english, masked=s.mask_words, english_words=read_words(s.english_words), buckets=s.mask_buckets, lists=read_word_lists(s.word_lists))

    def features(self, cleaned: DataFrame) -> DataFrame:
        return enrich(cleaned, self.settings, self.contacts)

    def samples(self, enriched: DataFrame) -> DataFrame:
        return samples(enriched, self.settings)

    def run(self, path: str, out: str, as_of=None) -> DataFrame:
        """All stages, each stored under out and read again, then the JSON Lines of the splits."""

        def stored(df: DataFrame, name: str) -> DataFrame:
            write_stage(df, f"{out}/{name}.parquet")
            return self.spark.read.parquet(f"{out}/{name}.parquet")

        parsed = stored(self.parse(path, as_of), "parsed")
        if parsed.isEmpty():
            raise ValueError(f"no messages in {path} since the cutoff")
        enriched = stored(self.features(stored(self.clean(parsed), "cleaned")), "enriched")
        contexts = stored(self.samples(enriched), "contexts")
        write_splits(contexts, out)
        return contexts
