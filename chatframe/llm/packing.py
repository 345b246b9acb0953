"""Items of varying length into containers of fixed capacity: hierarchical residual packing."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

CAPACITY = 2048
NEARLY_FULL = 0.99
FAN_IN = 8
_BIN = "used bigint, members array<struct<id:bigint,piece:int,n:bigint>>"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the items of each bin: from the largest item, each into the bin with the least room that is enough."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # the different rooms, sorted; at most capacity of them
    at_room: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        at = bisect_left(rooms, sizes[i])
        if at < len(rooms):
            room = rooms[at]
            b = at_room[room].pop()
            if not at_room[room]:
                del at_room[room], rooms[at]
            bins[b].append(i)
            left = room - sizes[i]
        else:
            b, left = len(bins), capacity - sizes[i]
            bins.append([i])
        if left:
            if left not in at_room:
                at_room[left] = []
                insort(rooms, left)
            at_room[left].append(b)
    return bins


def _fit(batches: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Best fit of the items of one task; an item is a piece of a text or a bin that was left underfull."""
    used: list[int] = []
    members: list = []
    for pdf in batches:
        used += pdf["used"].tolist()
        members += pdf["members"].tolist()
    bins = best_fit(used, capacity)
    for at in range(0, len(bins), 10_000):
        part = bins[at : at + 10_000]
        yield pd.DataFrame({"used": [sum(used[i] for i in b) for b in part], "members": [members[b[0]] if len(b) == 1 else np.concatenate([members[i] for i in b]) for b in part]})


def helped(counts: dict[int, int], capacity: int) -> dict[int, float]:
    """The share of the underfull bins of each size that another round can help; counts: how many there are of each.

    Bins up to half full can go into others, so they stay. A bin beyond half only gains if one of those goes into it: of
    all that have room for some, as many stay as there are, the fullest first.
    """
    half = capacity // 2
    small = sorted(s for s in counts if s <= half)
    share, taken = {s: 1.0 for s in small}, 0
    for s in sorted((s for s in counts if s > half), reverse=True):
        fits = sum(counts[x] for x in small if x <= capacity - s)
        kept = max(0, min(counts[s], fits - taken))
        share[s] = kept / counts[s]
        taken += kept
    return share


def pack(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, nearly: float = NEARLY_FULL, fan_in: int = FAN_IN) -> DataFrame:
    """Rows container_id, key, piece_no, start, n, used: every item once, whole unless larger than the capacity.

    A larger item is cut at multiples of the capacity: its full pieces fill containers of their own, the rest is packed.
    Items of size 0 or null take no container and give no row. Every partition packs what it has; containers filled to
    nearly are done. Of the others only those that can still gain travel on as items, to a fan_in-th of the tasks, until
    one task packs what is left: best fit leaves a task at most one bin up to half full, and of the fuller ones no more
    stay than there are such bins, so a round carries about two rows per task of the round before, whatever the sizes.
    What stays is chosen by a histogram of the fill, at most capacity rows. Members ride along, at most capacity of them.
    Rounds are cut through the shared folder. keys are integers; a task holds the keys and sizes of its partition.
    """
    items = sizes.where(F.col(size) > 0).select(F.col(key).cast("bigint").alias("id"), F.col(size).cast("bigint").alias("n"))
    pieces = items.select("id", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)).alias("piece"))
    pieces = pieces.select("id", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("bigint") * capacity).alias("n"))
    todo = pieces.select(F.col("n").alias("used"), F.array(F.struct("id", "piece", "n")).alias("members"))
    tasks, done = sizes.rdd.getNumPartitions(), []
    full = F.col("used") >= nearly * capacity
    while True:
        packed = cut(todo.mapInPandas(lambda b: _fit(b, capacity), _BIN))
        if tasks == 1:
            done.append(packed)
            break
        counts = {r["used"]: r["n"] for r in packed.where(~full).groupBy("used").agg(F.count("*").alias("n")).collect()}
        share = F.create_map(*(F.lit(x) for s, p in helped(counts, capacity).items() if p > 0 for x in (s, p))) if counts else None
        stays = ~full & (F.coalesce(F.try_element_at(share, "used"), F.lit(0.0)) > F.pmod(F.xxhash64("members"), F.lit(1 << 30)) / (1 << 30)) if counts else F.lit(False)
        done.append(packed.where(~stays))
        if not counts:
            break
        tasks = max(1, tasks // fan_in)
        todo = packed.where(stays).repartition(tasks) if tasks > 1 else packed.where(stays).coalesce(1)
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    head = F.array_min("members")
    named = every.select(F.concat_ws("-", head["id"], head["piece"]).alias("container_id"), "used", F.explode("members").alias("m"))
    return named.select("container_id", F.col("m.id").alias(key), (F.col("m.piece") + 1).alias("piece_no"), (F.col("m.piece").cast("bigint") * capacity).alias("start"), F.col("m.n").alias("n"), "used")


def totals(packed: DataFrame, sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """One row on whether the items are whole: n_items, n_overfull (containers beyond the capacity), n_cut (items up to
    the capacity in more than one piece) and n_wrong (items whose pieces don't add up to their size)."""
    bins = packed.groupBy("container_id").agg(F.sum("n").alias("n")).agg(F.count_if(F.col("n") > capacity).alias("n_overfull"))
    got = packed.groupBy(key).agg(F.count("*").alias("pieces"), F.sum("n").alias("got"))
    both = sizes.where(F.col(size) > 0).select(key, size).join(got, key, "full")
    each = both.agg(F.count("got").alias("n_items"), F.count_if((F.col("pieces") > 1) & (F.col(size) <= capacity)).alias("n_cut"), F.count_if(~F.col("got").eqNullSafe(F.col(size))).alias("n_wrong"))
    return each.join(bins)  # one row each
