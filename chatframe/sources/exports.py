"""Plain-text chat exports, one file per chat, as message tables."""

from __future__ import annotations

import logging
import math
import os
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clean import is_media
from ..functions.pytext import D, LINE_BREAK, WS, bind, strip
from ..runtime import tasks

#: Texts of notices that the app writes, found anywhere in a header line's text in any case.
SYSTEM_MARKERS = (
    "messages and calls are end-to-end encrypted", "this message was deleted", "you deleted this message", "missed voice call", "missed video call", "created group",
    "added you", "left", "changed the group", "changed their phone number", "your security code with",
)
#: The form of a header line, and of a notice's.
HEADER = rf"^({D}{{1,2}}/{D}{{1,2}}/{D}{{2,4}}),[{WS}]*({D}{{1,2}}:{D}{{2}}(?:[{WS}]*[AaPp][Mm])?)[{WS}]*-[{WS}]*([^:]+):[{WS}](.*)$"
SLICE_LINES = 200_000
#: Bytes of files that a task reads, on average.
TASK_BYTES = 16 << 20
#: What a file's name can't hold or the readers of folders take for something else, and how it is written instead.
ESCAPED = {"%": "%25", "/": "%2F", ":": "%3A", "\0": "%00"}
NOTICE_HEADER = rf"^{D}{{1,2}}/{D}{{1,2}}/{D}{{2,4}},[{WS}]*{D}{{1,2}}:{D}{{2}}(?:[{WS}]*[AaPp][Mm])?[{WS}]*-[{WS}]"


def header_time(date: Column, time: Column) -> Column:
    """timestamp_ntz of a header's date and time, day first, month first where that fails; null if neither is possible.

    Two-digit years below 69 are 20yy, the others 19yy; three-digit years fail. AM or PM needs a blank before it and an
    hour from 1 to 12.
    """
    shape = rf"^({D}{{1,2}}):({D}{{2}})(?:[{WS}]+([AaPp])[Mm])?$"
    zero = F.lit(0).cast("decimal(8,6)")

    def of(x: Column) -> Column:
        a, b, y = x.d[0].try_cast("int"), x.d[1].try_cast("int"), x.d[2]
        year = F.when(F.length(y) == 4, y.try_cast("int")).when(F.length(y) == 2, y.try_cast("int") + F.when(y.try_cast("int") >= 69, 1900).otherwise(2000))
        hour = F.when(x.half == "", x.h).when(x.h.between(1, 12), x.h % 12 + F.when(x.half == "P", 12).otherwise(0))
        return bind(F.struct(year.alias("y"), F.when(hour.between(0, 23) & (x.mi < 60), hour).alias("h")), lambda t: F.coalesce(F.try_make_timestamp_ntz(t.y, b, a, t.h, x.mi, zero), F.try_make_timestamp_ntz(t.y, a, b, t.h, x.mi, zero)))

    h, mi, half = (F.regexp_extract(time, shape, i) for i in (1, 2, 3))
    return bind(F.struct(F.split(date, "/").alias("d"), h.try_cast("int").alias("h"), mi.try_cast("int").alias("mi"), F.upper(half).alias("half")), of)


def is_system(sender: Column, text: Column) -> Column:
    """Whether the header line is a notice of the app."""
    found = bind(F.lower(text), lambda low: reduce(Column.__or__, (low.contains(m) for m in SYSTEM_MARKERS)))
    return found | strip(sender).isin("", "~")


def fold_lines(lines: DataFrame, drop_headerless_notices: bool = False, slice_lines: int = SLICE_LINES) -> DataFrame:
    """Messages of numbered lines: source_file, pos, line -> the parsed schema.

    A header opens a message, the lines up to the next header continue it, stripped and joined by a blank. What precedes
    the first header, and a message with an impossible date or of the app, is dropped with its continuation. Notices
    without a colon continue the message before, unless drop_headerless_notices. A chat of any length is folded in slices of
    slice_lines values of pos; only the lines of one message meet in one row. Lines without source_file are left out.
    """
    line = F.translate("line", "\u202f\u00a0", "  ")
    marked = lines.select("source_file", "pos", line.alias("line"), line.rlike(HEADER).alias("_head"))
    if drop_headerless_notices:
        marked = marked.where(F.col("_head") | ~F.col("line").rlike(NOTICE_HEADER))
    # a chat is cut into slices of lines; the last header before a slice comes along
    marked = marked.withColumn("_slice", F.floor(F.col("pos") / slice_lines).cast("bigint")).where("source_file is not null and _slice is not null").repartition("source_file", "_slice")
    # no header is empty; as this has the columns that the window below has, one exchange and one reading of the files serve both
    head = F.when(F.col("_head") & (F.length("line") > 0), F.col("pos"))
    ends = marked.groupBy("source_file", "_slice").agg(F.max(head).alias("_end"))
    before = ends.select("source_file", "_slice", F.max("_end").over(Window.partitionBy("source_file").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    w = Window.partitionBy("source_file", "_slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("_local", F.max(head).over(w)).join(before, ["source_file", "_slice"])
    blocks = local.withColumn("_block", F.coalesce("_local", "_before")).where("_block is not null")
    # the first line of a message holds its first part, so only the others are gathered
    part = F.when(~F.col("_head"), F.nullif(strip(F.col("line")), F.lit("")))
    grouped = blocks.groupBy("source_file", "_block").agg(F.max(F.when(F.col("_head"), F.col("line"))).alias("_line"), F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct("pos", part.alias("s"))))).alias("_parts"))

    def message(g: Column) -> Column:
        """Of date, time and sender:text; no sender holds a colon."""
        sender = F.substring_index(g[2], ":", 1)
        text = F.substr(g[2], F.length(sender) + 2)
        return bind(F.struct(sender.alias("sender"), text.alias("text")), lambda m: F.struct(
            header_time(g[0], g[1]).alias("datetime"), strip(m.sender).alias("sender"), F.array_join(F.concat(F.array(strip(m.text)), F.transform("_parts", lambda p: p.s)), " ").alias("text"), F.col("source_file"),
            is_media(m.text).alias("is_media"), F.col("_block").cast("bigint").alias("line_no"), is_system(m.sender, m.text).alias("_system"),
        ))

    # one pass of the pattern, and each value computed once: a filter on computed columns would compute them again
    fields = F.split(F.regexp_replace("_line", HEADER, "$1,$2,$3:$4"), ",", 3)
    return grouped.select(F.inline(F.filter(F.transform(F.array(fields), message), lambda m: m.datetime.isNotNull() & ~m["_system"]))).drop("_system")


def read_lines(spark: SparkSession, path: str, keep_bom: bool = False) -> DataFrame:
    """source_file (the file's name without its last suffix), pos, line of every text file in a folder, or of one file."""
    stem = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))), r"\.[^.]+$", "")
    # bytes, since the reader of texts takes a millisecond to open a file, this one a tenth
    files = spark.read.format("binaryFile").load(path, pathGlobFilter="*.txt")
    # the reader counts a file as 4 MB at least, so small ones would be a few to a task: as many tasks as their bytes need
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    whole = files.select(stem.alias("source_file"), F.make_valid_utf8(F.col("content").cast("string")).alias("value")).coalesce(max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES)))
    if not keep_bom:
        whole = whole.withColumn("value", F.regexp_replace("value", "^\ufeff", ""))
    return whole.select("source_file", F.posexplode(F.split("value", LINE_BREAK)).alias("pos", "line"))


def file_name(chat: str) -> str:
    """The name, without suffix, of a chat's file: its own name but for what ESCAPED holds and a leading ``_`` or ``.``."""
    name = "".join(ESCAPED.get(c, c) for c in chat)
    return f"%{ord(name[0]):02X}{name[1:]}" if name[:1] in ("_", ".") else name or "%"


def chat_name(name: Column) -> Column:
    """The chat that file_name gave this name to."""
    out = F.when(name == "%", "").otherwise(name)
    for c, written in [("_", "%5F"), (".", "%2E"), *reversed(ESCAPED.items())]:  # the sign itself last
        out = F.replace(out, F.lit(written), F.lit(c))
    return out


def write_exports(lines: DataFrame, folder: str) -> None:
    """source_file, pos, line as one text file per chat in a new folder, named by file_name, its lines in order of pos.

    Where the folder is in a file system that the workers can open, each task writes its chats' files at once, under another
    name until they are whole; elsewhere Spark writes them and the driver names them, one after the other.
    """
    spark = lines.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    placed = lines.repartition(tasks(spark), "source_file").sortWithinPartitions("source_file", "pos").select("source_file", F.col("line").alias("value"))
    if fs.getUri().getScheme() == "file":
        here = at.toUri().getPath()

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chat = out = None
            part = os.path.join(here, f".{uuid.uuid4().hex}")

            def close() -> None:
                out.close()
                os.replace(part, os.path.join(here, f"{file_name(chat)}.txt"))

            for b in batches:
                for name, rows in groupby(zip(b.column("source_file").to_pylist(), b.column("value").to_pylist()), itemgetter(0)):
                    if name != chat:
                        if out:
                            close()
                        chat, out = name, open(part, "wb")
                    out.write("".join(f"{line or ''}\n" for _, line in rows).encode())
            if out:
                close()
            yield from ()

        placed.mapInArrow(write, "source_file string").write.format("noop").mode("overwrite").save()
        return
    placed.write.partitionBy("source_file").text(f"{folder}/by_chat")
    for chat in fs.listStatus(jvm.Path(f"{folder}/by_chat")):
        if chat.isDirectory():
            name = unquote(chat.getPath().getName().split("=", 1)[1])
            (part,) = fs.listStatus(chat.getPath())
            if not fs.rename(part.getPath(), jvm.Path(at, f"{file_name('' if name == '__HIVE_DEFAULT_PARTITION__' else name)}.txt")):
                raise OSError(f"{name}: not written")


def parse_exports(spark: SparkSession, path: str, dedup: bool = True, check: bool = True, **options) -> DataFrame:
    """All messages of a folder of exports, each once. Raises if there is no file or, with check, no message; the check
    runs the parse until it finds one, so callers that store the result should check that instead.

    Files whose names begin with ``_`` or ``.`` are skipped by the reader, with a warning.
    """
    from ..operators.dedup import dedup_messages

    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    # only the skipped ones come here one by one: a folder may hold a file for each of many chats
    if not len(fs.globStatus(jvm.Path(at, "*.txt")) or []):
        raise FileNotFoundError(f"no .txt files in {path}")
    if hidden := [s.getPath().getName() for s in fs.globStatus(jvm.Path(at, "[._]*.txt")) or []]:
        logging.getLogger(__name__).warning("skipped: %s", ", ".join(hidden))
    out = fold_lines(read_lines(spark, path), **options)
    if check and out.isEmpty():
        raise ValueError(f"no messages in {path}")
    return dedup_messages(out) if dedup else out
