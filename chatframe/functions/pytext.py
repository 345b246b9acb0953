"""White space, words and digits by Unicode, as patterns that Java's regex and RE2 both read, and helpers on them."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inside brackets: what counts as white space, as a word character, as a digit.
WS = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
W = r"\p{L}\p{N}_"
D = r"\p{Nd}"
#: Where a text export breaks lines.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def strip(c: Column) -> Column:
    """Without outer white space of any script."""
    return F.regexp_replace(c, rf"^[{WS}]+|[{WS}]+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{WS}]+$", "")


def tokens(c: Column) -> Column:
    """The parts between white space; none for an empty text."""
    return F.filter(F.split(c, rf"[{WS}]+"), lambda x: x != "")


def redact(c: Column, keep: int, none: str | None = None) -> Column:
    """A stripped preview of at most keep characters with ``...`` behind a cut; null gives none."""
    s = strip(c)
    short = F.when(F.length(s) <= keep, s).otherwise(F.concat(F.substring(s, 1, keep), F.lit("...")))
    return short if none is None else F.coalesce(short, F.lit(none))


def bind(value: Column, use) -> Column:
    """use(value) with value computed once however often it is used: a one-element array and its lambda variable."""
    return F.transform(F.array(value), use)[0]


def constant(value, kind: str) -> Column:
    """A nested constant as one literal of a DDL type; planning a tree of single literals would take seconds."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)
