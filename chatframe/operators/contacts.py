"""Relationship of each message by a ranked lookup in the owner's address book."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pytext import bind, constant, strip
from ..runtime import cut
from .ordered import carried

MOST_CONTACTS = 20_000
#: Different (sender, chat) pairs up to which their contacts are broadcast, at most some 60 MB.
MOST_PAIRS = 200_000


@dataclass(frozen=True)
class Contacts:
    """names: (name, phone, relationship) in order; groups: (fragment of a chat's name, relationship) in order."""

    names: tuple[tuple[str, str, str], ...] = ()
    groups: tuple[tuple[str, str], ...] = ()
    default: str = "acquaintance"
    you: str = "You"

    @classmethod
    def of(cls, names: Sequence[tuple], groups: Sequence[tuple] = (), default: str | None = None, you: str = "You") -> Contacts:
        """A name that comes again keeps its place and takes the later phone and relationship; empty names are dropped."""
        kept: dict[str, tuple[str, str]] = {}
        for name, phone, relationship in names:
            if name and (key := name.strip().lower()):
                kept[key] = (phone, relationship)
        if len(kept) > MOST_CONTACTS or len(groups) > MOST_CONTACTS:
            raise ValueError(f"more than {MOST_CONTACTS} contacts")
        return cls(tuple((n, *v) for n, v in kept.items()), tuple((g.lower(), r) for g, r in groups if g), default or "acquaintance", you)

    @classmethod
    def read(cls, path: str) -> Contacts:
        """From the JSON document of a person's contacts; invalid JSON raises, a missing file gives no contacts."""
        try:
            with open(path, encoding="utf-8") as f:
                doc = json.load(f)
        except FileNotFoundError:
            return cls()
        people = doc.get("contacts", {})
        names = [(c.get("name", ""), phone, c.get("relationship", doc.get("default_relationship", "acquaintance"))) for phone, c in people.items()]
        return cls.of(names, list(doc.get("group_chats", {}).items()), doc.get("default_relationship"), doc.get("your_name_in_exports", "You"))

    @staticmethod
    def your_name(path: str, default: str = "You") -> str:
        """The owner's name in exports as the document of read() gives it; default if the file is missing or no JSON object."""
        try:
            with open(path, encoding="utf-8") as f:
                return json.load(f).get("your_name_in_exports", default)
        except (OSError, ValueError, AttributeError):
            return default

    @classmethod
    def from_table(cls, df: DataFrame, you: str = "You", default: str | None = None) -> Contacts:
        """From a small table name, phone, relationship, ordered by phone; its size is checked."""
        rows = df.select("name", "phone", "relationship").where("name is not null").orderBy("phone", "name").limit(MOST_CONTACTS + 1).collect()
        return cls.of([(r["name"], r["phone"], r["relationship"] or default or "acquaintance") for r in rows], (), default, you)


def tag_relationships(df: DataFrame, contacts: Contacts) -> DataFrame:
    """df with recipient_phone and relationship, the first hit of: a group's fragment in the chat's name; the sender (not
    you), then the chat, each first as a whole name, then with either inside the other, in the book's order.

    The book is a literal of checked size. The different pairs of sender and chat are stored and looked up once each; up to
    MOST_PAIRS of them are broadcast to the messages, which aren't shuffled. Beyond that every row is looked up where it is.
    Null senders and chats find nothing; without a hit the phone is ``unknown`` and the relationship the default.
    """
    rows = df.drop("recipient_phone", "relationship")
    pairs = cut(rows.select("sender", "source_file").distinct())
    if pairs.count() > MOST_PAIRS:
        return _looked_up(rows, contacts)
    found = _looked_up(pairs, contacts).select(F.col("sender").alias("_s"), F.col("source_file").alias("_f"), F.col("recipient_phone").alias("_phone"), F.col("relationship").alias("_relationship"))
    both = rows.select(carried(rows), F.col("sender").alias("_sender"), F.col("source_file").alias("_file")).join(F.broadcast(found), F.col("_sender").eqNullSafe(F.col("_s")) & F.col("_file").eqNullSafe(F.col("_f")))
    return both.select("_row.*", F.col("_phone").alias("recipient_phone"), F.col("_relationship").alias("relationship"))


def _looked_up(df: DataFrame, contacts: Contacts) -> DataFrame:
    """df with recipient_phone and relationship, each row by itself."""
    hit = "struct<name:string,phone:string,relationship:string>"
    people = constant([{"name": n, "phone": p, "relationship": r} for n, p, r in contacts.names], f"array<{hit}>")
    groups = constant([{"name": g, "phone": "group", "relationship": r} for g, r in contacts.groups], f"array<{hit}>")

    def first(found: Column) -> Column:
        return F.try_element_at(found, F.lit(1))

    if contacts.names:
        whole = constant({n: {"name": n, "phone": p, "relationship": r} for n, p, r in contacts.names}, f"map<string,{hit}>")
        inside = "|".join(re.escape(n).replace("\\ ", " ") for n, *_ in contacts.names)
        around = F.lit("\n".join(n for n, *_ in contacts.names))

    def candidate(key: Column) -> list[Column]:
        if not contacts.names:
            return []
        # the book is only gone through if some name is in the key or the key in some name
        part = F.when(key.rlike(inside) | around.contains(key), first(F.filter(people, lambda c: key.contains(c["name"]) | c["name"].contains(key))))
        return [F.when(key != "", F.try_element_at(whole, key)), F.when(key != "", part)]

    def of(k: Column) -> Column:
        group = first(F.filter(groups, lambda g: k["chat"].contains(g["name"])))
        return bind(F.coalesce(group, *candidate(k["sender"]), *candidate(k["stem"])), lambda h: F.struct(F.coalesce(h["phone"], F.lit("unknown")).alias("phone"), F.coalesce(h["relationship"], F.lit(contacts.default)).alias("relationship")))

    chat = F.lower(F.coalesce("source_file", F.lit("")))
    sender = F.when(F.coalesce(F.col("sender") == contacts.you, F.lit(True)), F.lit("")).otherwise(strip(F.lower("sender")))
    keys = F.struct(chat.alias("chat"), sender.alias("sender"), strip(chat).alias("stem"))
    # a generator computes the hit once for both columns
    return df.select("*", F.inline(F.array(bind(keys, of))).alias("recipient_phone", "relationship"))
