"""Features of single messages as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pytext import W, rstrip, tokens

_BASE = r"[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F900}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{231A}\x{231B}\x{23E9}-\x{23F3}]"
_ONE = _BASE + r"\x{FE0F}?[\x{1F3FB}-\x{1F3FF}]?"
#: A flag, a keycap, or signs joined into one by U+200D.
EMOJI = rf"[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|[0-9#*]\x{{FE0F}}?\x{{20E3}}|{_ONE}(?:\x{{200D}}{_ONE})*"
#: Any sign of the usual blocks, for usage rates.
EMOJI_SIGN = r"[\x{1F300}-\x{1FFFF}\x{2600}-\x{27BF}]"
CAPS_WORD = rf"(?<![{W}])[A-Z]{{2,}}(?![{W}])"


def emoji_count(c: Column) -> Column:
    """Number of emoji as seen: a joined sequence, a flag or one with a skin tone counts once."""
    return F.regexp_count(c, F.lit(EMOJI)).cast("bigint")


def message_features(df: DataFrame, text: str = "text", emoji=emoji_count) -> DataFrame:
    """df with message_length, word_count, emoji_count and the flags; a null text gives nulls."""
    t = F.col(text)
    words = F.size(tokens(t)).cast("bigint")
    counted = df.withColumns({"message_length": F.length(t).cast("bigint"), "word_count": F.when(t.isNotNull(), words), "emoji_count": emoji(t)})
    return counted.withColumns({
        "has_emoji": F.col("emoji_count") > 0,
        "ends_ellipsis": rstrip(t).endswith("..."),
        "ends_question": rstrip(t).endswith("?"),
        "has_caps_word": t.rlike(CAPS_WORD),
        "is_single_word": F.col("word_count") == 1,
        "is_very_short": F.col("message_length") <= 3,
    })


def calendar_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """df with hour, day_of_week (Monday 0), day_name, is_weekend and month."""
    at = F.col(ts)
    return df.withColumns({"hour": F.hour(at), "day_of_week": F.weekday(at), "day_name": F.date_format(at, "EEEE"), "is_weekend": F.weekday(at).isin(5, 6), "month": F.month(at)})


def conversation_id(source_file: Column) -> Column:
    """Eight hexadecimal digits of the chat's name."""
    return F.substring(F.md5(source_file), 1, 8)


def twelve_hour(hour: Column) -> Column:
    """``10 PM``"""
    h = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    return F.concat(h.cast("string"), F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")))
