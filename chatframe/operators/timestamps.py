"""Mixed timestamp notations and zones to instants in UTC.

Each value gets an array of all its valid interpretations. Where the row's device says how to read it, one is left.
Values with several are decided by Viterbi over their source's record order: changing the date order costs, and so does
going back in time. The path is exact over any length: chunks of about CHUNK records are reduced to their (min, +)
matrices, the matrices of a source are folded in order, and each chunk is then traced back between its fixed ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pytext import bind
from ..functions.timeparse import abbreviations, readings, utc_us, zone_names
from ..runtime import cut, tasks

CHUNK = 100_000
SWITCH_COST, BACK_COST, MDY_COST = 1.0, 2.0, 0.01
_NEVER = 1e18


def interpretations(df: DataFrame, devices: DataFrame, value: str = "datetime", device: str = "device_id") -> DataFrame:
    """df with ``readings``: array<struct<kind string, utc_us bigint>>, empty if the value names no instant.

    devices: device_id, zone, day_first; one row per device counts. Its zones are collected (bounded by the zone
    database), the table itself is joined. A null or unknown device leaves zone-less values without an instant and slash
    dates with both orders. Null, empty and unreadable values get an empty array.
    """
    known = devices.groupBy(F.col("device_id").alias("_device")).agg(F.min("zone").alias("_zone"), F.min("day_first").alias("_day_first"))
    zones = [r[0] for r in devices.select("zone").where("zone is not null").distinct().collect()]
    names, offsets = zone_names(df.sparkSession), abbreviations(zones)
    at = df.join(known, F.col(device) == F.col("_device"), "left")
    wanted = F.filter(readings(F.col(value)), lambda r: F.col("_day_first").isNull() | ~r.kind.isin("dmy", "mdy") | (r.kind == F.when(F.col("_day_first"), "dmy").otherwise("mdy")))
    instants = F.transform(wanted, lambda r: F.struct(r.kind.alias("kind"), utc_us(r.local_us, r.zone, F.col("_zone"), names, offsets).alias("utc_us")))
    valid = bind(F.filter(instants, lambda r: r.utc_us.isNotNull()), lambda rs: F.filter(rs, lambda r, i: (i == 0) | (r.utc_us != rs[0].utc_us)))
    return at.withColumn("readings", F.coalesce(valid, F.array().cast("array<struct<kind:string,utc_us:bigint>>"))).drop("_device", "_zone", "_day_first")


def _states(readings) -> list[tuple[int, int, float]]:
    """(time, date order, own cost) of each reading of a row; date order 0 none, 1 dmy, 2 mdy."""
    return [(r["utc_us"], {"dmy": 1, "mdy": 2}.get(r["kind"], 0), MDY_COST if r["kind"] == "mdy" and len(readings) > 1 else 0.0) for r in readings]


def _step(a: tuple, b: tuple) -> float:
    """Cost of going from one state to the next row's."""
    return (BACK_COST if b[0] < a[0] else 0.0) + (SWITCH_COST if a[1] and b[1] and a[1] != b[1] else 0.0)


def _forward(rows: list[list[tuple]], first: int | None = None) -> tuple[list[float], list[list[int]]]:
    """Least cost to each state of the last row, from the given state of the first or from any, and where it came from."""
    cost = [c if first in (None, i) else _NEVER for i, (_, _, c) in enumerate(rows[0])]
    came = []
    for before, now in zip(rows, rows[1:]):
        if len(before) == 1 == len(now):  # most rows: nothing to choose
            cost = [cost[0] + _step(before[0], now[0]) + now[0][2]]
            came.append([0])
            continue
        new, origin = [], []
        for s in now:
            best, at = min((c + _step(p, s), i) for i, (c, p) in enumerate(zip(cost, before)))
            new.append(best + s[2])
            origin.append(at)
        cost = new
        came.append(origin)
    return cost, came


def _path(rows: list[list[tuple]], first: int, last: int) -> list[int]:
    """The chosen state of each row between fixed ends."""
    path = [last]
    for origin in reversed(_forward(rows, first)[1]):
        path.append(origin[path[-1]])
    return path[::-1]


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(source, chunk, rows as states, frame) of the chunks of sorted batches; a chunk may straddle batches."""
    rest: list[pd.DataFrame] = []

    def done():
        pdf = pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0].reset_index(drop=True)
        for (source, chunk), part in pdf.groupby(["source", "chunk"], sort=False):
            yield source, chunk, list(map(_states, part["readings"])), part

    for pdf in batches:
        if not len(pdf):
            continue
        same = ((pdf["source"] == pdf["source"].iloc[-1]) & (pdf["chunk"] == pdf["chunk"].iloc[-1])).to_numpy()
        cut_ = 0 if same.all() else len(same) - int(np.argmin(same[::-1]))
        tail = pdf.iloc[cut_:]
        if cut_ or rest and (rest[-1]["source"].iloc[-1], rest[-1]["chunk"].iloc[-1]) != (tail["source"].iloc[0], tail["chunk"].iloc[0]):
            rest.append(pdf.iloc[:cut_])
            yield from done()
            rest = []
        rest.append(tail)
    if rest:
        yield from done()


def _matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each chunk the states of its first and last row and the least cost from each to each."""
    for source, chunk, rows, _ in _runs(batches):
        m = [_forward(rows, i)[0] for i in range(len(rows[0]))]
        flat = lambda states: [float(x) for s in states for x in s]
        yield pd.DataFrame({"source": [source], "chunk": [chunk], "head": [[s[0] for s in rows[0]]], "tail": [[s[0] for s in rows[-1]]], "kinds": [[s[1] for s in rows[0]] + [s[1] for s in rows[-1]]], "m": [[x for row in m for x in row]], "own": [flat([(s[2],) for s in rows[0]])]})


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Both end states of every chunk of whole sources, whose matrices come in order."""
    rows: list = []

    def trace() -> pd.DataFrame:
        cost, came, tail = [], [], []
        for r in rows:
            head = list(zip(r.head, r.kinds[: len(r.head)], r.own))
            if tail:
                enter = [min((c + _step(p, s), i) for i, (c, p) in enumerate(zip(cost, tail))) for s in head]
            else:
                enter = [(0.0, -1)] * len(head)
            n = len(r.tail)
            through = [min((enter[i][0] + r.m[i * n + j], i) for i in range(len(head))) for j in range(n)]
            came.append(([e[1] for e in enter], [t[1] for t in through]))
            cost, tail = [t[0] for t in through], list(zip(r.tail, r.kinds[len(r.head) :], [0.0] * n))
        last, ends = cost.index(min(cost)), []
        for origin, via in reversed(came):
            first = via[last]
            ends.append((first, last))
            last = origin[first]
        ends.reverse()
        return pd.DataFrame({"source": [r.source for r in rows], "chunk": [r.chunk for r in rows], "first": [a for a, _ in ends], "last": [b for _, b in ends]})

    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if rows and rows[-1].source != r.source:
                yield trace()
                rows = []
            rows.append(r)
    if rows:
        yield trace()


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chosen readings of the rows with several, of sorted chunks with their end states."""
    for source, _, rows, part in _runs(batches):
        path = _path(rows, int(part["first"].iloc[0]), int(part["last"].iloc[0]))
        picked = [(rec, rs[j]) for rec, rs, j in zip(part["rec"], part["readings"], path) if len(rs) > 1]
        yield pd.DataFrame({"source": [source] * len(picked), "rec": [rec for rec, _ in picked], "kind": [r["kind"] for _, r in picked], "utc_us": [r["utc_us"] for _, r in picked]})


def viterbi(ours: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chosen reading of the rows with several: source, rec, kind, utc_us.

    ours: source, rec, readings of whole sources; rec is unique and gives the record order. Rows are divided by ranges of
    (source, rec) into parts of about chunk rows, whatever the ids' values, and stored once through the shared folder; the
    rows of a source in a part are one of its chunks.
    """
    some = cut(ours.where(F.size("readings") > 0).select("source", "rec", "readings"))
    parts = max(1, math.ceil(some.count() / chunk))
    placed = cut(some.repartitionByRange(parts, "source", "rec").withColumn("chunk", F.spark_partition_id().cast("bigint")).sortWithinPartitions("source", "rec"))
    matrices = placed.mapInPandas(_matrices, "source string, chunk bigint, head array<bigint>, tail array<bigint>, kinds array<int>, m array<double>, own array<double>")
    ends = matrices.repartition("source").sortWithinPartitions("source", "chunk").mapInPandas(_fold, "source string, chunk bigint, first int, last int")
    both = placed.join(ends, ["source", "chunk"]).repartition("source", "chunk").sortWithinPartitions("source", "chunk", "rec")
    return both.mapInPandas(_choose, "source string, rec bigint, kind string, utc_us bigint")


def normalise_timestamps(df: DataFrame, devices: DataFrame, record: str = "msg_id", source: str = "source_file", value: str = "datetime", device: str = "device_id") -> DataFrame:
    """One row per record whose value names one instant: record, kind (the notation), utc_us.

    Rows that are alike count once; rows without record are left out; an empty table gives an empty result. A slash date
    of a device without date order is decided over its source; without a source it is read day first. Only rows of such
    devices, and the sources that they are in, take that way.
    """
    every = df.where(F.col(record).isNotNull()).select(F.col(record).cast("bigint").alias("rec"), F.col(source).alias("source"), F.col(value).alias("value"), F.col(device).alias("device"))
    rows = every.repartition(tasks(df.sparkSession), "rec").distinct()  # the exchange serves distinct, too
    read = interpretations(rows, devices, "value", "device")
    # a generator computes the array once, where a filter on its size would compute it again
    each = read.select("rec", F.inline(bind(F.col("readings"), lambda rs: F.transform(rs, lambda r: F.struct(r.kind.alias("kind"), r.utc_us.alias("utc_us"), F.size(rs).alias("n"))))))
    clear = each.where("n = 1").drop("n")

    def undecided(rows: DataFrame) -> DataFrame:
        lacking = rows.join(devices.where("day_first is not null").select(F.col("device_id").alias("device")).distinct(), "device", "left_anti")
        return interpretations(lacking, devices, "value", "device").where(F.size("readings") > 1)

    if undecided(every).isEmpty():  # a scan without a shuffle
        return clear.withColumnRenamed("rec", record)
    unclear = undecided(rows)
    alone = unclear.where("source is null").select("rec", F.inline(F.slice("readings", 1, 1)))
    ours = interpretations(rows.join(unclear.where("source is not null").select("source").distinct(), "source", "left_semi"), devices, "value", "device")
    decided = viterbi(ours.select("source", "rec", "readings")).select("rec", "kind", "utc_us")
    return clear.unionByName(alone).unionByName(decided).withColumnRenamed("rec", record)
