"""Schemas of the stage tables, the order key and the settings of a pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The total order of messages: time, then chat, then place in its export. Every ordered operator takes it as a parameter.
ORDER = ("datetime", "source_file", "line_no")

PARSED = "datetime timestamp_ntz, sender string, text string, source_file string, is_media boolean, line_no bigint"
SAMPLE = "text string"
EVALUATION = "id bigint, generated string, context_preview string, true_preview string, context string, `true` string"

#: The relationships that a contact may have.
RELATIONSHIPS = ("best_friend", "close_friend", "girlfriend", "family", "colleague", "acquaintance", "stranger", "group_close", "group_formal")



def relationship(value: str) -> str:
    """value if it is a relationship that a contact may have; raises otherwise."""
    if value not in RELATIONSHIPS:
        raise ValueError(f"{value!r} is none of {', '.join(RELATIONSHIPS)}")
    return value


@dataclass(frozen=True)
class Settings:
    """Defaults as a user of chat exports expects them."""

    you: str = "You"
    context_size: int = 5
    gap_s: int = 3600
    ghost_s: int = 86_400
    min_reply: int = 2
    max_reply: int = 500
    cutoff_months: int = 24
    remove_devanagari: bool = True
    remove_english: bool = False
    mask_words: tuple[str, ...] = field(default=())
    mask_buckets: tuple[str, ...] = field(default=())
    word_lists: str | None = None
    english_words: str | None = None
    scope: str = "global"
