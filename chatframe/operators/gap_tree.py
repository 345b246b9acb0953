"""Sessions as cuts of a Cartesian tree over the gaps between neighbouring events of an entity.

The tree of an entity has one leaf per *atom* (the events of one time slot) and one inner node per gap between
neighbouring atoms, the largest gap at the root. Every node knows its span, its number of events, its own gap (0 for a
leaf) and the gap of its parent (null at the root). The sessions for a threshold are the nodes with
``gap <= threshold < parent_gap``, a plain filter: one stored tree serves every threshold from the slot length up.

Events are counted into slots first, by (entity, day), so a busy entity is spread over as many tasks as it has days. The
tree is built per chunk (entity, stretch of time), so an entity with a third of all rows is spread over as many tasks as it
has stretches, and a chunk holds at most as many atoms as it has slots. In a chunk every gap that is no maximum seen from one of the chunk's ends has its parent inside the
chunk; those nodes are final. What remains, the two spines, is merged per entity. Atoms, chunks and so the merge are
bounded by the time that the data spans, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOT_S = 60
DAY_S = 86_400
CHUNK_S = 30 * 86400

_NODE = "start_us bigint, end_us bigint, n_events bigint, gap_us bigint, parent_gap_us bigint"


def _micros(c: str) -> F.Column:
    """Microseconds of a timestamp with or without zone, wall clock of the latter taken as it is."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(`{c}` as timestamp_ntz))")


def _spans(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each gap the places of the nearest larger gap before it and of the nearest one at least as large after it."""
    n = len(gaps)
    left, right, stack = np.full(n, -1), np.full(n, n), []
    for i, g in enumerate(gaps.tolist()):
        while stack and stack[-1][1] <= g:
            right[stack.pop()[0]] = i
        if stack:
            left[i] = stack[-1][0]
        stack.append((i, g))
    return left, right


_OPEN = np.iinfo(np.int64).max


def _chunk_nodes(key: np.ndarray, start: np.ndarray, end: np.ndarray, n: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Final nodes and open items of several whole chunks, whose atoms lie in order; key tells the chunks apart.

    A border between two chunks counts as an endless gap, so one pass serves all chunks.
    """
    gaps = np.where(key[1:] == key[:-1], start[1:] - end[:-1], _OPEN) if len(key) else np.empty(0, np.int64)
    left, right = _spans(gaps)
    total = np.concatenate([[0], np.cumsum(n)])
    bound = np.concatenate([[_OPEN], gaps, [_OPEN]])  # of atom i: bound[i] before, bound[i + 1] after
    inner = gaps != _OPEN
    at = np.flatnonzero(inner)
    before, after = left[at], right[at]
    lg, rg = bound[before + 1], bound[after + 1]
    nodes = pd.DataFrame({"row": before + 1, "last": after, "start_us": start[before + 1], "end_us": end[after], "n_events": total[after + 1] - total[before + 1], "gap_us": gaps[at], "parent_gap_us": np.minimum(lg, rg)})
    spine = (lg == _OPEN) | (rg == _OPEN)
    leaf = np.arange(len(key))
    closed_leaf = (bound[:-1] != _OPEN) & (bound[1:] != _OPEN)
    leaves = pd.DataFrame({"row": leaf, "last": leaf, "start_us": start, "end_us": end, "n_events": n, "gap_us": 0, "parent_gap_us": np.minimum(bound[:-1], bound[1:])})
    closed = pd.concat([nodes[~spine], leaves[closed_leaf]], ignore_index=True)
    # the spine gaps cut a chunk into closed blocks; each block is one item of the sequence that is merged later
    cuts = np.concatenate([[0], np.flatnonzero(~inner) + 1, at[spine] + 1])
    first = np.unique(cuts[cuts < len(key)])
    last = np.append(first[1:], len(key)) - 1
    items = pd.DataFrame({"row": first, "last": last, "start_us": start[first], "end_us": end[last], "n_events": total[last + 1] - total[first], "gap_us": 0, "parent_gap_us": np.where(closed_leaf[first] | (first != last), -1, 0)})
    return closed, items


def _chunks(batches: Iterator[pd.DataFrame], threshold_us: int | None) -> Iterator[pd.DataFrame]:
    """Nodes and items of sorted atoms; chunks may straddle batches."""

    def nodes(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = pdf.entity + "\x00" + pdf.chunk.astype(str)
        key = pd.factorize(whole)[0]
        closed, items = _chunk_nodes(key, pdf.start_us.to_numpy(), pdf.end_us.to_numpy(), pdf.n_events.to_numpy())
        if threshold_us is not None:
            closed = closed[(closed.gap_us <= threshold_us) & (closed.parent_gap_us > threshold_us)]
        both = pd.concat([closed.assign(is_item=False), items.assign(is_item=True)], ignore_index=True)
        both.insert(0, "entity", pdf.entity.to_numpy()[both.row.to_numpy()])
        return both.drop(columns=["row", "last"])

    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        at = pdf.iloc[-1]
        same = ((pdf.entity == at.entity) & (pdf.chunk == at.chunk)).to_numpy()
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut or rest and (rest[-1].entity.iloc[-1], rest[-1].chunk.iloc[-1]) != (at.entity, at.chunk):
            done = pd.concat([*rest, pdf.iloc[:cut]], ignore_index=True)
            rest = []
            yield nodes(done)
        rest.append(pdf.iloc[cut:])
    if rest:
        yield nodes(pd.concat(rest, ignore_index=True))


def _merge(batches: Iterator[pd.DataFrame], threshold_us: int | None) -> Iterator[pd.DataFrame]:
    """Nodes over the items of whole entities, sorted; entities may straddle batches."""

    def nodes(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pd.factorize(pdf.entity)[0]
        start, end, n = pdf.start_us.to_numpy(), pdf.end_us.to_numpy(), pdf.n_events.to_numpy()
        gaps = np.where(key[1:] == key[:-1], start[1:] - end[:-1], _OPEN)
        left, right = _spans(gaps)
        total, bound = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[_OPEN], gaps, [_OPEN]])
        at = np.flatnonzero(gaps != _OPEN)
        before, after = left[at], right[at]
        inner = pd.DataFrame({"row": before + 1, "start_us": start[before + 1], "end_us": end[after], "n_events": total[after + 1] - total[before + 1], "gap_us": gaps[at], "parent_gap_us": np.minimum(bound[before + 1], bound[after + 1])})
        single = np.flatnonzero(pdf.parent_gap_us.to_numpy() == 0)  # atoms at the ends of chunks; other items are final nodes already
        leaf = pd.DataFrame({"row": single, "start_us": start[single], "end_us": end[single], "n_events": n[single], "gap_us": 0, "parent_gap_us": np.minimum(bound[single], bound[single + 1])})
        out = pd.concat([inner, leaf], ignore_index=True)
        if threshold_us is not None:
            out = out[(out.gap_us <= threshold_us) & (out.parent_gap_us > threshold_us)]
        out.insert(0, "entity", pdf.entity.to_numpy()[out.row.to_numpy()])
        return out.drop(columns="row")

    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        same = (pdf.entity == pdf.entity.iloc[-1]).to_numpy()
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut or rest and rest[-1].entity.iloc[-1] != pdf.entity.iloc[-1]:
            yield nodes(pd.concat([*rest, pdf.iloc[:cut]], ignore_index=True))
            rest = []
        rest.append(pdf.iloc[cut:])
    if rest:
        yield nodes(pd.concat(rest, ignore_index=True))


def gap_tree(df: DataFrame, entity: str, ts: str, event_id: str, *, slot_s: int = SLOT_S, chunk_s: int = CHUNK_S, threshold_s: int | None = None) -> DataFrame:
    """The nodes of every entity's tree: entity, start_us, end_us, n_events, gap_us, parent_gap_us (null at a root).

    Rows without entity or time are left out; rows with the same event_id count once, rows without one once
    for each time. Ties in time fall into one atom. An empty table gives an empty tree. With threshold_s only the nodes that are
    sessions at this threshold leave the tasks.
    """
    if chunk_s % slot_s:
        raise ValueError("chunk_s must be a multiple of slot_s")
    if threshold_s is not None and threshold_s < slot_s:
        raise ValueError("a threshold below the slot length needs a tree with shorter slots")
    us = None if threshold_s is None else threshold_s * 1_000_000
    events = df.select(F.col(entity).cast("string").alias("entity"), _micros(ts).alias("us"), F.col(event_id).alias("id")).where("entity is not null and us is not null")
    # events move to the task of their day, both groupings need no other exchange; atoms, one a slot, to that of their chunk
    chunk, slot = (F.floor(F.col("us") / F.lit(s * 1_000_000)).cast("int") for s in (chunk_s, slot_s))
    day = F.floor(slot / F.lit(max(1, DAY_S // slot_s))).cast("int")  # whole slots
    spread = events.withColumns({"chunk": chunk, "day": day, "slot": slot}).repartition("entity", "chunk", "day")
    atoms = (
        spread.groupBy("entity", "chunk", "day", "slot", "id", F.when(F.col("id").isNull(), F.col("us"))).agg(F.min("us").alias("us"))
        .groupBy("entity", "chunk", "day", "slot").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("n_events"))
        .drop("day").repartition("entity", "chunk").sortWithinPartitions("entity", "chunk", "slot")
    )
    local = atoms.mapInPandas(lambda b: _chunks(b, us), f"entity string, {_NODE}, is_item boolean")
    merged = local.where("is_item").drop("is_item").repartition("entity").sortWithinPartitions("entity", "start_us").mapInPandas(lambda b: _merge(b, us), f"entity string, {_NODE}")
    nodes = local.where("not is_item").drop("is_item").unionByName(merged)
    return nodes.withColumn("parent_gap_us", F.nullif("parent_gap_us", F.lit(_OPEN)))


def cut_tree(tree: DataFrame, threshold_s: int) -> DataFrame:
    """The sessions at one threshold: entity, start_us, end_us, duration_us, n_events."""
    at = F.lit(threshold_s * 1_000_000)
    return tree.where((F.col("gap_us") <= at) & (F.col("parent_gap_us").isNull() | (F.col("parent_gap_us") > at))).select("entity", "start_us", "end_us", (F.col("end_us") - F.col("start_us")).alias("duration_us"), "n_events")


def sessions(df: DataFrame, entity: str, ts: str, event_id: str, *, threshold_s: int = 3600, slot_s: int = SLOT_S, chunk_s: int = CHUNK_S) -> DataFrame:
    """Sessions of one threshold through the tree: neighbours at most threshold_s apart belong together."""
    return cut_tree(gap_tree(df, entity, ts, event_id, slot_s=slot_s, chunk_s=chunk_s, threshold_s=threshold_s), threshold_s)
