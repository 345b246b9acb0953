"""Groups of records that belong together, and splits that keep them whole."""

from __future__ import annotations

import heapq
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

SPLITS = {"train": 0.85, "val": 0.10, "test": 0.05}
BINS = 20
BLOCK = 20_000


def phone_key(phone: Column) -> Column:
    """The last ten digits in any script; null for fewer than ten digits or ten equal ones."""
    digits = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None]
    plain = "".join(str(unicodedata.decimal(c)) for c in digits)
    ten = F.substring(F.regexp_replace(F.when(phone.rlike(r"^[\x00-\x7F]*$"), phone).otherwise(F.translate(phone, "".join(digits), plain)), "[^0-9]", ""), -10, 10)
    return F.when((F.length(ten) == 10) & ~ten.rlike(r"^(\d)\1{9}$"), ten)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """id, group_id of every node of an undirected graph given by links (a, b): the smallest id that it is connected with.

    Alternating large and small stars: every round is two aggregations by node, partial before the shuffle, and a join of
    the links with one row per node, which adaptive execution splits where a node is hot. The links shrink to one star
    per component in O(log^2) rounds; each round is cut through the shared folder. Null ends are left out.
    """
    edges = cut(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null").distinct())
    nodes = edges.select("u").union(edges.select("v")).distinct()
    edges = edges.where("u <> v")

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(low, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = None
    while True:
        edges = cut(star(star(edges, True), False))
        if (now := mark(edges)) == last or not now[0]:
            break
        last = now
    return nodes.join(edges.select("u", F.col("v").alias("m")), "u", "left").select(F.col("u").alias("id"), F.coalesce("m", "u").alias("group_id"))


def conversation_groups(df: DataFrame, conversation: str = "conversation_id", phone: str = "recipient_phone") -> DataFrame:
    """conversation_id, group_id: conversations that share a phone, directly or through others; loners are their own group.

    A phone's conversations are linked to the smallest of them, so a phone that a third of all rows share makes one link
    per conversation. Null conversations are left out.
    """
    known = df.where(F.col(conversation).isNotNull()).select(F.col(conversation).alias("c"), phone_key(F.col(phone)).alias("p")).distinct()
    first = known.where("p is not null").groupBy("p").agg(F.min("c").alias("m"))
    links = known.join(first, "p", "left").select("c", F.coalesce("m", "c").alias("m"))
    return components(links, "c", "m").withColumnsRenamed({"id": conversation})


def _difference(weights: list[float], bins: int) -> list[int]:
    """A bin for each weight by largest differencing: the two partial partitions with the widest spread are joined, heavy
    bins of one to light bins of the other, until one is left."""
    heap = []
    for i, w in enumerate(weights):
        heap.append((-w, i, [(w, [i])]))  # bins are listed from the heaviest; those not listed are empty
    heapq.heapify(heap)
    n = len(weights)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        if len(x) + len(y) <= bins:
            z = x + y
        else:
            x, y = x + [(0.0, [])] * (bins - len(x)), y + [(0.0, [])] * (bins - len(y))
            z = [(a + c, [*p, *q] if q else p) for (a, p), (c, q) in zip(x, reversed(y))]
        z.sort(key=lambda t: -t[0])
        if len(z) == bins:
            base = z[-1][0]
            spread = z[0][0] - base
        else:
            spread = z[0][0]
        n += 1
        heapq.heappush(heap, (-spread, n, z))
    out = [0] * len(weights)
    if heap:
        for b, (_, members) in enumerate(heap[0][2]):
            for i in members:
                out[i] = b
    return out


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """The items of one block of a stratum into BINS equal bins, which are named by their smallest item."""
    pdf = pdf.sort_values(["w", "item"], ascending=[False, True], ignore_index=True)
    b = pd.Series(_difference(pdf.w.tolist(), BINS))
    return pd.DataFrame({"stratum": pdf.stratum, "item": pdf["item"], "w": pdf.w, "bin": pdf["item"].groupby(b).transform("min")})


def _allot(pdf: pd.DataFrame) -> pd.DataFrame:
    """The items of a stratum into bins and the bins to splits: the heaviest first to the split that lacks most."""
    pdf = pdf.sort_values(["w", "item"], ascending=[False, True])
    b = _difference(pdf.w.tolist(), BINS)
    total = pd.Series(pdf.w.to_numpy()).groupby(b).sum().sort_values(ascending=False, kind="stable")
    lack = {s: share * total.sum() for s, share in SPLITS.items()}
    to = {}
    for bin_, w in total.items():
        to[bin_] = max(lack, key=lambda s: (lack[s] - max(0, w - lack[s]), SPLITS[s]))
        lack[to[bin_]] -= w
    return pd.DataFrame({"stratum": pdf.stratum, "item": pdf["item"], "split": [to[x] for x in b]})


def grouped_split(df: DataFrame, groups: DataFrame, record: str = "sample_id", unit: str = "conversation_id", stratum: str = "relationship", most_items: int = 50_000) -> DataFrame:
    """record, unit, group_id, stratum, split of every record: whole groups per split, SPLITS nearly kept in each stratum.

    groups: unit, group_id. Records count once. A record without unit is a group of its own; a group belongs to the
    stratum that most of its records name (the smallest of equals; null counts as a stratum of its own). Strata of many
    groups are first binned in blocks of about BLOCK groups, told apart by a hash, by largest differencing, then the bins are binned again,
    until at most most_items are left per stratum; whole bins then go to the splits. A group heavier than a split's share
    goes to train.
    """
    rows = df.groupBy(record).agg(F.min(F.struct(unit, stratum)).alias("r")).select(record, f"r.{unit}", F.coalesce(f"r.{stratum}", F.lit("")).alias("stratum"))
    rows = cut(rows.join(groups, unit, "left").withColumn("group_id", F.coalesce("group_id", F.concat(F.lit("record "), F.col(record).cast("string")))))
    counts = rows.groupBy("group_id", "stratum").count()
    items = counts.groupBy("group_id").agg(F.sum("count").cast("double").alias("w"), F.min(F.struct(-F.col("count"), "stratum")).alias("s")).select(F.col("group_id").alias("item"), "w", F.col("s.stratum").alias("stratum"))
    item_of = items.select(F.col("item").alias("group_id"), "item")
    # always one round in blocks, more while a stratum has too many items for one task
    most = items.groupBy("stratum").count().agg(F.max("count")).first()[0] or 0
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-most // BLOCK)))).cast("int")
        binned = cut(items.withColumn("block", block).groupBy("stratum", "block").applyInPandas(_block, "stratum string, item string, w double, bin string"))
        item_of = item_of.join(binned.select("item", "bin"), "item").select("group_id", F.col("bin").alias("item"))
        items = binned.groupBy("stratum", F.col("bin").alias("item")).agg(F.sum("w").alias("w"))
        most = items.groupBy("stratum").count().agg(F.max("count")).first()[0] or 0
        if most <= most_items:
            break
    split = items.groupBy("stratum").applyInPandas(_allot, "stratum string, item string, split string").select("item", "split")
    placed = item_of.join(split, "item").select("group_id", "split")
    return rows.join(placed, "group_id").select(record, unit, "group_id", F.nullif("stratum", F.lit("")).alias(stratum), "split")


def wholeness(split: DataFrame, record: str = "sample_id", unit: str = "conversation_id") -> DataFrame:
    """One row: n_records, n_twice (records with several rows), n_torn (groups and units in several splits)."""
    once = split.groupBy(record).count().agg(F.count("*").alias("n_records"), F.count_if(F.col("count") > 1).alias("n_twice"))
    ends = split.select("split", F.explode(F.array(F.concat(F.lit("g"), "group_id"), F.concat(F.lit("u"), unit))).alias("of")).where("of is not null").distinct()
    torn = ends.groupBy("of").count().agg(F.count_if(F.col("count") > 1).alias("n_torn"))
    return once.join(torn)  # one row each
