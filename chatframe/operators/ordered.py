"""Features that depend on the order of messages, without one task that holds the order.

Time is cut into slices of a bounded number of rows, by a histogram of the data's own times. Within a slice window
functions do the work; what a row needs from other slices (the message before and after, running sums and maxima) travels
in one summary row per slice. So neither the global order nor a hot chat nor a busy day ends in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pytext import bind, constant

#: Rows of a slice; data of fewer rows than SLICES times as many are cut into about SLICES slices.
SLICE_ROWS, SLICES = 1_000_000, 128
#: Equal stretches of time that a slice is made of on average, the most there are in all, and the parts that a stretch with
#: too many rows is cut into.
SLICE_CELLS, CELLS, PARTS, DEPTH = 16, 65_536, 256, 4


def micros(c: Column) -> Column:
    """Wall clock of a timestamp as microseconds, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz"))


FEATURES = ("timedelta_prev", "session_break", "session_id", "position", "reply_chain_depth", "ghosted")


def carried(df: DataFrame, *replaced: str) -> Column:
    """All columns of df but the replaced ones as one, so that their names can't clash with those of a computation."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in replaced]
    return F.struct(*kept).alias("_row") if kept else F.struct(F.lit(None).cast("string").alias("_")).alias("_row")


def _part(us: Column, low: Column, high: Column) -> Column:
    """Which of PARTS equal parts of low..high a time lies in."""
    return F.greatest(F.lit(0), F.least(F.lit(PARTS - 1), F.floor((us - low) / (high - low + 1) * PARTS).cast("int")))


@dataclass(frozen=True)
class TimeSlices:
    """Slices of time: stretches of width us from low on, each in a slice or, where it is crowded, cut into PARTS.

    crowded: first and last time of each such stretch and the slices of its parts; a negative number n instead of a slice
    is the place -1 - n in crowded, where the stretch or part is cut further, depth times at most.
    """

    low: int = 0
    width: int = 1
    of_cell: tuple[int, ...] = (0,)
    crowded: tuple[tuple[int, int, tuple[int, ...]], ...] = ()
    depth: int = 0

    def of(self, us: Column) -> Column:
        """The number of a time's slice; later times are never in earlier slices."""
        cell = F.floor((us - F.lit(self.low)) / F.lit(self.width)).cast("int")
        out = constant(list(self.of_cell), "array<int>")[F.greatest(F.lit(0), F.least(F.lit(len(self.of_cell) - 1), cell))]
        if not self.crowded:
            return out
        parts = constant([{"a": a, "b": b, "p": list(p)} for a, b, p in self.crowded], "array<struct<a:bigint,b:bigint,p:array<int>>>")

        def inner(s: Column) -> Column:
            here = bind(parts[F.greatest(F.lit(0), F.least(F.lit(len(self.crowded) - 1), -1 - s))], lambda c: c["p"][_part(us, c["a"], c["b"])])
            return F.when((s >= 0) | (-1 - s >= len(self.crowded)), s).otherwise(here)

        for _ in range(self.depth):
            out = bind(out, inner)
        return out


def time_slices(times: DataFrame, us: str = "_us", most: int = SLICE_ROWS) -> TimeSlices:
    """Slices of at most about most rows of a column of microseconds, from two or more counts of it.

    The driver sees one number per stretch of time, at most CELLS, and PARTS for each that has too many rows of its own;
    those parts that still have too many are counted again, up to DEPTH times. Rows of one instant stay together.
    """
    low, high, n = times.agg(F.min(us), F.max(us), F.count(us)).first()
    most = max(min(most, max(1, n // SLICES)), 8 * n // CELLS)
    if n <= most:
        return TimeSlices()
    width = max(1, -(-(high - low + 1) // min(CELLS, SLICE_CELLS * -(-n // most))))
    seen = times.where(F.col(us).isNotNull()).select(F.col(us).alias("us"))
    n_cells = -(-(high - low + 1) // width)

    def counted(df: DataFrame, *keys: Column) -> dict[tuple, tuple[int, int, int]]:
        """Rows, first and last time by keys."""
        return {tuple(r[:-3]): tuple(r[-3:]) for r in df.groupBy(*keys).agg(F.count("*"), F.min("us"), F.max("us")).collect()}

    stretches: list[tuple[int, int, list]] = []  # first and last time, and by part either its rows or the place of its own stretch

    def entry(found: tuple[int, int, int] | None) -> tuple[str, int]:
        """How many rows a cell or part has, or, if they are too many, where it is cut further."""
        k, a, b = found or (0, 0, 0)
        if k <= most or a == b or depth == DEPTH:
            return "rows", k
        stretches.append((a, b, []))
        return "place", len(stretches) - 1

    depth, done = 0, 0
    by_cell = counted(seen, F.floor((F.col("us") - F.lit(low)) / F.lit(width)).cast("int"))
    cells = [entry(by_cell.get((c,))) for c in range(n_cells)]
    numbered = lambda entries: tuple(-1 - x if kind == "place" else 0 for kind, x in entries)
    while done < len(stretches):
        known = TimeSlices(low, width, numbered(cells), tuple((a, b, numbered(e)) for a, b, e in stretches[:done]), depth)
        ends = constant({str(i): list(stretches[i][:2]) for i in range(done, len(stretches))}, "map<string,array<bigint>>")
        crowd = seen.select("us", known.of(F.col("us")).alias("s")).where("s < 0").select("us", (-1 - F.col("s")).alias("i")).withColumn("e", F.try_element_at(ends, F.col("i").cast("string")))
        by_part = counted(crowd, F.col("i"), _part(F.col("us"), F.col("e")[0], F.col("e")[1]))
        depth, begin, done = depth + 1, done, len(stretches)
        for i in range(begin, done):
            stretches[i][2].extend(entry(by_part.get((i, p))) for p in range(PARTS))
    now, held = 0, 0

    def numbers(entries: list) -> tuple[int, ...]:
        """The slices of cells or parts in order of time."""
        nonlocal now, held
        out = []
        for kind, x in entries:
            if kind == "place":
                final[x] = (*stretches[x][:2], numbers(stretches[x][2]))
                out.append(-1 - x)
                continue
            if held and held + x > most:
                now, held = now + 1, 0
            held += x
            out.append(now)
        return tuple(out)

    final: list = [None] * len(stretches)
    of_cell = numbers(cells)
    return TimeSlices(low, width, of_cell, tuple(final), depth)


def order_features(df: DataFrame, you: str, scope: str = "global", gap_s: float = 3600, ghost_s: float = 86_400, slice_rows: int = SLICE_ROWS, ties: tuple[str, ...] = ("line_no",), slices: TimeSlices | None = None) -> DataFrame:
    """df with timedelta_prev, session_break, session_id, position, reply_chain_depth and ghosted.

    scope global: the message before is the one before in the order of all chats (datetime, source_file, ties), so
    interleaved chats break each other's sessions; scope chat: the one before in the same source_file. session_id counts
    the breaks of a chat. Rows without datetime have no place in the order and are left out; a null source_file is a chat
    of its own; a null sender is never you and differs from every neighbour but another null. Equal rows follow each other
    in any order. An empty table gives an empty result with the columns. Columns of these names are replaced, others of any
    name are carried along. slices: those of df's times, where the caller knows them from a cheaper plan; others are as right.
    """
    if scope not in ("global", "chat"):
        raise ValueError(scope)
    keys = ["_chat"] if scope == "chat" else []
    order = ["_us", "_chat", *ties]
    needed = list(dict.fromkeys(["source_file", "sender", *ties]))
    rows = df.select(carried(df, *FEATURES), *needed, micros(F.col("datetime")).alias("_us")).where("_us is not null")
    if slices is None:
        slices = time_slices(df.select(micros(F.col("datetime")).alias("_us")), "_us", slice_rows)
    rows = rows.withColumns({"_slice": slices.of(F.col("_us")), "_chat": F.coalesce(F.concat(F.lit("c"), F.col("source_file")), F.lit("n")), "_you": F.coalesce(F.col("sender") == you, F.lit(False))})
    this, place = F.struct("_us", "_chat", "sender", "_you"), F.struct(*order)

    def breaks(row: Column, before: Column) -> Column:
        return before.isNull() | ((row["_us"] - before["_us"]) / F.lit(1e6) > gap_s) | (row["_chat"] != before["_chat"])

    def turns(row: Column, before: Column) -> Column:
        return (before.isNull() | ~row["sender"].eqNullSafe(before["sender"])) & ~row["_you"]

    # inside a slice; the first row's own turn and break wait for the slices before
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    sofar = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"_p": F.lag(this).over(inside), "_n": F.lead("_us").over(inside)})
    local = local.withColumn("_c", F.sum((F.col("_p").isNotNull() & turns(this, F.col("_p"))).cast("bigint")).over(sofar))
    local = local.withColumn("_y", F.max(F.when(F.col("_you"), F.col("_c"))).over(sofar))

    # one row per slice: what comes before and after it, and the counts at its beginning
    ends = local.groupBy(*keys, "_slice").agg(F.min_by(this, place).alias("_first"), F.max_by(this, place).alias("_last"), F.max("_c").alias("_m"), F.max("_y").alias("_my"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice") if keys else Window.orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({"_before": F.lag("_last").over(by_slice), "_after": F.lead(F.col("_first._us")).over(by_slice)})
    ends = ends.withColumn("_t", turns(F.col("_first"), F.col("_before")).cast("bigint"))
    ends = ends.withColumn("_c0", F.coalesce(F.sum(F.col("_m") + F.col("_t")).over(earlier), F.lit(0)) + F.col("_t")).withColumn("_y0", F.max(F.col("_c0") + F.col("_my")).over(earlier))
    seen = local.join(ends.select(*keys, "_slice", "_before", "_after", "_c0", "_y0"), [*keys, "_slice"])
    before, after = F.coalesce("_p", "_before"), F.coalesce("_n", "_after")
    seen = seen.select(
        "_row", *order, "_slice",
        F.greatest(F.lit(0.0), F.coalesce((F.col("_us") - before["_us"]) / F.lit(1e6), F.lit(0.0))).alias("timedelta_prev"),
        breaks(this, before).alias("session_break"),
        (F.col("_c0") + F.col("_c") - F.coalesce(F.col("_c0") + F.col("_y"), F.col("_y0"), F.lit(0))).alias("reply_chain_depth"),
        (~F.col("_you") & F.coalesce((after - F.col("_us")) / F.lit(1e6) > ghost_s, F.lit(False))).alias("ghosted"),
    )

    # sessions are counted per chat, by the same means
    in_chat = Window.partitionBy("_chat", "_slice").orderBy(*order)
    seen = seen.withColumns({"_s": F.sum(F.col("session_break").cast("bigint")).over(in_chat.rowsBetween(Window.unboundedPreceding, 0)), "_nb": F.lead("session_break").over(in_chat)})
    chat_slices = seen.groupBy("_chat", "_slice").agg(F.max("_s").alias("_ns"), F.min_by("session_break", place).alias("_fb"))
    of_chat = Window.partitionBy("_chat").orderBy("_slice")
    more = chat_slices.select("_chat", "_slice", F.coalesce(F.sum("_ns").over(of_chat.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s0"), F.coalesce(F.lead("_fb").over(of_chat), F.lit(True)).alias("_ab"))
    out = seen.join(more, ["_chat", "_slice"]).withColumn("session_id", F.col("_s0") + F.col("_s"))
    first, last = F.col("session_break"), F.coalesce("_nb", "_ab")
    out = out.withColumn("position", F.when(first & ~last, "opener").when(last & ~first, "closer").otherwise("mid"))
    return out.select("_row.*", *FEATURES)
