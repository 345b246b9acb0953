"""Cleaning of message texts as one Column expression per rule; the order of rules and of masks matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pytext import WS, D, W, bind, strip, tokens

#: Common English words that are removed on request.
ENGLISH_WORDS = (
    "the a an and or but with this that these those from have has had will would should could shall may might must been being "
    "there their they them then than when where while which who what how why each both some into onto upon about above below "
    "between through during before after because therefore however although though"
)
#: Words that are masked on request, by language.
NSFW_WORDS = {
    "english": "fuck fucking fucked motherfucker motherfucking bitch bitches asshole bastard dick cock pussy slut whore cum cumming",
    "hinglish": "bc bkl bhenchod behenchod madarchod mc chutiya chuitya lund lawda lauda gaand gand randi harami kamina kaminey",
    "hindi": "भोसड़ी भोसड़ी भोसडी बहनचोद बेहनचोद मादरचोद चूतिया चुतिया लौड़ा लौंडा लंड गांड रंडी हरामी कमीना",
}
#: What stands for a medium that was not exported (the first as it is, the second in any case).
MEDIA_EXACT, MEDIA_ANY_CASE = "<Media omitted>", "image omitted"

#: What is removed and masked.
DEVANAGARI = r"[\x{0900}-\x{097F}]+"
URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
PHONE = rf"(\+91|0)?[6-9]{D}" + "{9}"
EMAIL = rf"(?:(?<![{W}])(?=[{W}])|(?<=[{W}])(?![{W}]))[{W}.+-]+@[{W}-]+\.[{W}]+"
UPI = rf"(?:(?<![{W}])(?=[{W}])|(?<=[{W}])(?![{W}]))[{W}.]+@(okaxis|oksbi|okicici|ybl|paytm|upi)(?![{W}])"
TWELVE = rf"(?<![{W}]){D}{{4}}[{WS}]?{D}{{4}}[{WS}]?{D}{{4}}(?![{W}])"
EDGE = rf"^[^{W}\x{{0900}}-\x{{097F}}]+|[^{W}\x{{0900}}-\x{{097F}}]+$"


def is_media(c: Column) -> Column:
    return c.contains(MEDIA_EXACT) | F.lower(c).contains(MEDIA_ANY_CASE)


def remove_devanagari(c: Column) -> Column:
    return F.regexp_replace(c, DEVANAGARI, "")


def mask_pii(c: Column) -> Column:
    """URL, phone, e-mail, payment handle and twelve-digit id, in this order."""
    for pattern, mask in ((URL, "[URL]"), (PHONE, "[PHONE]"), (EMAIL, "[EMAIL]"), (UPI, "[UPI]"), (TWELVE, "[ID]")):
        c = F.regexp_replace(c, pattern, mask)
    return c


def remove_words(c: Column, words: Sequence[str] = tuple(ENGLISH_WORDS.split())) -> Column:
    """Without the tokens that, in lower case and with their punctuation, are in words; one space between the others."""
    listed = F.array(*(F.lit(w) for w in words)).cast("array<string>")
    return F.array_join(F.filter(tokens(c), lambda t: ~F.array_contains(listed, F.lower(t))), " ")


def core(token: Column) -> Column:
    """A token in lower case without outer punctuation."""
    return F.regexp_replace(F.lower(token), EDGE, "")


def mask_words(c: Column, words: Sequence[str], mask: str = "[NSFW]") -> Column:
    """Every token whose core is in words as mask; one space between tokens. No words: unchanged."""
    if not words:
        return c
    listed = F.array(*(F.lit(w) for w in words))
    return F.array_join(F.transform(tokens(c), lambda t: F.when(F.array_contains(listed, core(t)), F.lit(mask)).otherwise(t)), " ")


def active_words(buckets: Sequence[str], lists: dict[str, Sequence[str]] | None = None) -> tuple[str, ...]:
    """The words of all these buckets together, each once, in lower case; a bucket that lists lacks has none.

    lists: words by bucket, by default the built-in ones.
    """
    lists = {k: v.split() for k, v in NSFW_WORDS.items()} if lists is None else lists
    return tuple(dict.fromkeys(w.strip().lower() for b in buckets for w in lists.get(b, ()) if w.strip()))


def normalise_space(c: Column) -> Column:
    """Runs of two or more blanks as one space, outer ones removed; a single tab or line break stays."""
    return strip(F.regexp_replace(c, rf"[{WS}]{{2,}}", " "))


def clean_text(c: Column, devanagari: bool = True, english: bool = False, masked: Sequence[str] = (), pii: bool = True, english_words: Sequence[str] = tuple(ENGLISH_WORDS.split()), buckets: Sequence[str] = (), lists: dict[str, Sequence[str]] | None = None) -> Column:
    """All rules in order; null for null, empty and media texts and for results of at most one character.

    masked and the words of the active buckets (english, hinglish, hindi, or those of lists) are masked alike.
    """
    t = c
    if devanagari:
        t = remove_devanagari(t)
    if pii:
        t = mask_pii(t)
    if english:
        t = remove_words(t, english_words)
    t = normalise_space(mask_words(t, (*masked, *active_words(buckets, lists))))
    # the cheap test comes first: CASE stops there
    return F.when(c.isNull() | (c == "") | is_media(c), F.lit(None).cast("string")).otherwise(bind(t, lambda x: F.when(F.length(x) > 1, x)))


def clean_messages(df: DataFrame, text: str = "text", **rules) -> DataFrame:
    """df with its text cleaned, rows without a rest removed."""
    # a generator computes the text once, where a filter on it would compute it again
    kept = df.select("*", F.explode(F.array_compact(F.array(clean_text(F.col(text), **rules)))).alias("_cleaned"))
    return kept.select(*(F.col("_cleaned").alias(c) if c == text else F.col(c) for c in df.columns))
