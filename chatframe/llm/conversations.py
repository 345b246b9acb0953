"""Message rows back into ordered conversations of owner and contact turns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut

#: Kept conversations up to which their ids are broadcast, some 30 MB.
MOST_BROADCAST = 500_000
#: What exporting apps write in place of a medium, a deleted message or a missed call (whole text).
NOTICE = (
    r"^<?\s*(?:(?:media|image|video|audio|sticker|gif|document|photo|picture|file|voice message|voice note|contact card|contact|location|poll|view once message)s? (?:message )?(?:omitted|not included|was not included)"
    r"|(?:this message was|you|this message has been) deleted(?: this message)?|you deleted this message|(?:this )?message (?:was )?deleted|deleted message"
    r"|(?:you )?missed (?:a )?(?:group )?(?:voice |video |audio |phone )?(?:group )?call(?: from .{1,40}| at \d{1,2}[:.]\d{2}.{0,6})?)\s*>?\.?$"
)
BLANK = r"[\p{Z}\p{C}\s]"
#: A word-less run of the zero-width and direction marks inside names.
_MARKS = r"\p{Cf}"


def has_content(text: Column) -> Column:
    """Whether a text is more than blanks, invisible marks or a notice of the app; false for null."""
    seen = F.lower(F.regexp_replace(F.regexp_replace(text, _MARKS, ""), rf"^{BLANK}+|{BLANK}+$", ""))
    return F.coalesce((seen != "") & ~seen.rlike(NOTICE), F.lit(False))


def plain_name(name: Column) -> Column:
    """A sender's name without letter case, outer blanks and invisible marks; null if nothing or ``~`` remains."""
    seen = F.lower(F.regexp_replace(F.regexp_replace(name, _MARKS, ""), rf"^{BLANK}+|{BLANK}+$", ""))
    return F.when(~seen.isin("", "~"), seen)


def owner_keys(owners: DataFrame) -> list[str]:
    """The owner's names; a table of one person's names, refused beyond 1,000."""
    names = [r[0] for r in owners.select(plain_name(F.col("name")).alias("n")).where("n is not null").distinct().limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("more than 1,000 owner names")
    return names


def messages(df: DataFrame, owners: DataFrame) -> DataFrame:
    """conversation_id, at_us, line_no, speaker, role (owner, contact or null), text, has_content and msg_id of rows with a conversation."""
    who = plain_name(F.col("sender"))
    names = owner_keys(owners)
    role = F.when(who.isNull(), None).when(who.isin(names) if names else F.lit(False), "owner").otherwise("contact")
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("datetime").cast("timestamp_ntz"))
    return df.where("conversation_id is not null").select("conversation_id", "msg_id", at.alias("at_us"), "line_no", who.alias("speaker"), role.alias("role"), "text", has_content(F.col("text")).alias("has_content"))


def verdicts(said: DataFrame) -> DataFrame:
    """One row per conversation: status kept, empty, broken or unanswered, and its numbers of content messages by role.

    broken: a message with content lacks speaker or datetime; unanswered: no owner message with content comes after some
    contact message with content by (datetime, line_no); empty: no content at all. Every aggregate but the counts is
    blind to repeated rows, and all are partial before the shuffle, so a hot conversation costs one row per task. Equal
    (datetime, line_no) is not later. The counts count rows.
    """
    place = F.struct("at_us", "line_no")
    content = F.col("has_content")
    agg = said.groupBy("conversation_id").agg(
        F.count_if(content & F.col("role").eqNullSafe("owner")).alias("n_owner"),
        F.count_if(content & F.col("role").eqNullSafe("contact")).alias("n_contact"),
        F.max(content).alias("any"),
        F.max(content & (F.col("role").isNull() | F.col("at_us").isNull())).alias("broken"),
        F.min(F.when(content & (F.col("role") == "contact"), place)).alias("first_contact"),
        F.max(F.when(content & (F.col("role") == "owner"), place)).alias("last_owner"),
    )
    answered = F.coalesce(F.col("last_owner") > F.col("first_contact"), F.lit(False))
    status = F.when(~F.col("any"), "empty").when(F.col("broken"), "broken").when(~answered, "unanswered").otherwise("kept")
    return agg.select("conversation_id", status.alias("status"), "n_owner", "n_contact")


def _placed(lines: DataFrame, order: list[str]) -> DataFrame:
    """lines with prev: at_us and role of the line before in the conversation, by one exchange of the lines.

    lines: conversation_id, slice, at_us, role and the columns of order. Windows and groups by (conversation, slice) take
    the partitioning of the exchange; only one row per slice moves again.
    """
    spread = lines.repartition("conversation_id", "slice").distinct()
    edges = spread.groupBy("conversation_id", "slice").agg(F.max_by(F.struct("at_us", "role"), F.struct(*order)).alias("end"))
    before = edges.select("conversation_id", "slice", F.lag("end").over(Window.partitionBy("conversation_id").orderBy("slice")).alias("before"))
    here = F.lag(F.struct("at_us", "role")).over(Window.partitionBy("conversation_id", "slice").orderBy(*order))
    return spread.withColumn("here", here).join(before, ["conversation_id", "slice"]).withColumn("prev", F.coalesce("here", "before")).drop("here", "before")


def _sliced(said: DataFrame, slice_s: int) -> DataFrame:
    return said.withColumn("slice", F.floor(F.col("at_us") / F.lit(slice_s * 1_000_000)))


def gap_limits(said: DataFrame, *, bins: int = 120, least_s: int = 900, most_s: int = 86_400, default_s: int = 3600) -> DataFrame:
    """The calibrated inactivity gap of all chats, one row gap_us: the emptiest place between least_s and most_s in the
    histogram of log2 gaps (bins of a tenth of an octave), smoothed over five bins. Histogram and result are bounded.

    said: conversation_id, at_us, line_no, msg_id; rows without a time have no gap.
    """
    rows = said.where("at_us is not null").select("conversation_id", "at_us", "line_no", "msg_id", F.lit(None).cast("string").alias("role"))
    return _limit(_placed(_sliced(rows, 86_400), ["at_us", "line_no", "msg_id"]), least_s, most_s, default_s)


def _limit(placed: DataFrame, least_s: int = 900, most_s: int = 86_400, default_s: int = 3600) -> DataFrame:
    gaps = placed.select((F.col("at_us") - F.col("prev.at_us")).alias("gap")).where("gap > 0")
    hist = gaps.groupBy(F.floor(F.log2(F.col("gap") / 1e6) * 10).cast("int").alias("bin")).count()
    lo, hi = (int(math.log2(s) * 10) for s in (least_s, most_s))
    every = placed.sparkSession.range(lo - 2, hi + 3).select(F.col("id").cast("int").alias("bin")).join(F.broadcast(hist), "bin", "left").na.fill(0, ["count"])
    smooth = every.withColumn("mass", F.sum("count").over(Window.orderBy("bin").rowsBetween(-2, 2))).where(F.col("bin").between(lo, hi))
    best = smooth.agg(F.min(F.struct("mass", F.abs(F.col("bin") - int(math.log2(default_s) * 10)), "bin")).alias("b"))
    return best.select((F.pow(F.lit(2.0), (F.col("b.bin") + 0.5) / 10) * 1_000_000).cast("bigint").alias("gap_us"))


def rebuild(df: DataFrame, owners: DataFrame, *, slice_s: int = 86_400) -> DataFrame:
    """The kept conversations as ordered turns: conversation_id, session_no, turn_no, role, speaker, start_us, end_us,
    n_messages, text (the messages of the turn joined by newlines).

    A turn is a run of content messages of one role within a session; sessions are split at the calibrated gap. Only
    sessions with a contact message that the owner answers later in the session are returned. Order is (datetime,
    line_no, msg_id); rows that are alike count once. Slices of a day are numbered on their own and then shifted by
    what came before, so a conversation of any length is spread over as many tasks as it has days.
    """
    said = messages(df, owners)
    good = cut(verdicts(said).where("status = 'kept'").select("conversation_id"))
    kept = said.join(F.broadcast(good) if good.count() <= MOST_BROADCAST else good, "conversation_id", "left_semi")
    order = ["at_us", "line_no", "msg_id"]
    placed = _placed(_sliced(kept.where("has_content").drop("has_content"), slice_s), order)
    inside = Window.partitionBy("conversation_id", "slice").orderBy(*order)
    marked = placed.crossJoin(F.broadcast(_limit(placed)))  # one row
    marked = marked.withColumn("new_session", F.coalesce(F.col("at_us") - F.col("prev.at_us") > F.col("gap_us"), F.lit(True)))
    marked = marked.withColumn("new_turn", F.col("new_session") | (F.col("role") != F.col("prev.role")))
    sofar = inside.rowsBetween(Window.unboundedPreceding, 0)
    part = marked.withColumns({"s": F.sum(F.col("new_session").cast("bigint")).over(sofar), "t": F.sum(F.col("new_turn").cast("bigint")).over(sofar)})
    totals = part.groupBy("conversation_id", "slice").agg(F.max("s").alias("ns"), F.max("t").alias("nt"))
    earlier = Window.partitionBy("conversation_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("conversation_id", "slice", F.coalesce(F.sum("ns").over(earlier), F.lit(0)).alias("s0"), F.coalesce(F.sum("nt").over(earlier), F.lit(0)).alias("t0"))
    placed = part.join(shift, ["conversation_id", "slice"]).withColumns({"session_no": F.col("s") + F.col("s0"), "turn_no": F.col("t") + F.col("t0")})
    # the answered sessions of each slice, so that lines are chosen where they are
    parts = placed.groupBy("conversation_id", "slice", "session_no").agg(F.min(F.when(F.col("role") == "contact", F.col("turn_no"))).alias("c"), F.max(F.when(F.col("role") == "owner", F.col("turn_no"))).alias("o"))
    answered = parts.groupBy("conversation_id", "session_no").agg(F.min("c").alias("c"), F.max("o").alias("o")).where("o > c").select("conversation_id", "session_no")
    lists = parts.join(answered, ["conversation_id", "session_no"]).groupBy("conversation_id", "slice").agg(F.collect_set("session_no").alias("answered"))
    chosen = placed.join(lists, ["conversation_id", "slice"]).where(F.array_contains("answered", F.col("session_no")))
    return chosen.groupBy("conversation_id", "session_no", "turn_no", "role").agg(
        F.min_by("speaker", F.struct(*order)).alias("speaker"), F.min("at_us").alias("start_us"), F.max("at_us").alias("end_us"), F.count("*").alias("n_messages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda x: x.text), "\n").alias("text"),
    )
