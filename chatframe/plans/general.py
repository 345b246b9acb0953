"""Registered queries of the general data problems (sessions, timestamps)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gap_tree import gap_tree, sessions
from ..operators.timestamps import normalise_timestamps
from ..runtime import table

GAP_SETTINGS_S = (900, 3600, 21_600, 86_400)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    s = sessions(table(spark, folder, "enriched"), "source_file", "datetime", "msg_id", threshold_s=3600)
    return s.select(F.col("entity").alias("source_file"), "start_us", "end_us", F.col("n_events").alias("n_messages"))


def p2_gap_settings(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions per chat for several gap settings, all cut from one tree."""
    tree = gap_tree(table(spark, folder, "enriched"), "source_file", "datetime", "msg_id")
    settings = F.explode(F.array(*(F.lit(s).cast("bigint") for s in GAP_SETTINGS_S)))
    at = tree.withColumn("gap_s", settings).where("gap_us <= gap_s * 1000000 and (parent_gap_us is null or parent_gap_us > gap_s * 1000000)")
    return at.groupBy(F.col("entity").alias("source_file"), "gap_s").agg(F.count("*").alias("n_sessions"), F.sum("n_events").alias("n_messages"), F.max(F.col("end_us") - F.col("start_us")).alias("longest_us"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return normalise_timestamps(table(spark, folder, "parsed"), table(spark, folder, "devices")).select("msg_id", "utc_us")


def p4_notations(spark: SparkSession, folder: str) -> DataFrame:
    """How often each notation was read, per chat."""
    parsed = table(spark, folder, "parsed")
    read = normalise_timestamps(parsed, table(spark, folder, "devices"))
    chats = parsed.groupBy("msg_id").agg(F.min("source_file").alias("source_file"))
    return chats.join(read, "msg_id", "left").groupBy("source_file", F.coalesce("kind", F.lit("none")).alias("notation")).agg(F.count("*").alias("n_messages"))


def p4_hidden(spark: SparkSession, folder: str) -> DataFrame:
    """How many slash dates the record order decides as the device's date order would, with every third device's withheld,
    by source: n_messages, n_right."""
    parsed, devices = table(spark, folder, "parsed"), table(spark, folder, "devices")
    known = normalise_timestamps(parsed, devices).select("msg_id", F.col("utc_us").alias("right_us"))
    hidden = devices.withColumn("day_first", F.when(F.col("device_id") % 3 != 0, F.col("day_first")))
    read = normalise_timestamps(parsed, hidden).where("kind in ('dmy', 'mdy')")
    of = parsed.where("device_id % 3 = 0").groupBy("msg_id").agg(F.min("source_file").alias("source_file"))
    both = of.join(read, "msg_id").join(known, "msg_id")
    return both.groupBy("source_file").agg(F.count("*").alias("n_messages"), F.count_if(F.col("utc_us") == F.col("right_us")).alias("n_right"))


QUERIES = {"p4_hidden": p4_hidden, "p2_found": p2_found, "p2_gap_settings": p2_gap_settings, "p4_found": p4_found, "p4_notations": p4_notations}

_SESSIONS = """
with m as (select distinct msg_id, source_file, epoch_us(datetime) us from enriched where source_file is not null and datetime is not null),
g as (select *, us - lag(us) over (partition by source_file order by us, msg_id) gap from m),
s as (select g.*, t.gap_s, sum(case when gap is null or gap > t.gap_s * 1000000 then 1 else 0 end) over (partition by source_file, t.gap_s order by us, msg_id rows unbounded preceding) sid
      from g, (select cast(v as bigint) gap_s from (values {values}) x(v)) t),
r as (select source_file, gap_s, sid, min(us) start_us, max(us) end_us, count(*) n_messages from s group by all)
"""
SQL = {
    "p2_found": _SESSIONS.format(values="(3600)") + "select source_file, start_us, end_us, n_messages from r",
    "p2_gap_settings": _SESSIONS.format(values=", ".join(f"({s})" for s in GAP_SETTINGS_S)) + "select source_file, cast(gap_s as bigint) gap_s, count(*) n_sessions, cast(sum(n_messages) as bigint) n_messages, max(end_us - start_us) longest_us from r group by 1, 2",
}
