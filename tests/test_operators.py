"""Ordered features against a loop, contexts, contacts, splits, exports, evaluation, streaming."""

import json
import os
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chatframe.operators import evaluation, split, stats
from chatframe.operators.contacts import Contacts, tag_relationships
from chatframe.operators.contexts import append_context, chatml, context_windows, prompt
from chatframe.operators.dedup import cutoff, dedup_messages
from chatframe.operators.ordered import order_features, time_slices
from chatframe.plans.pipeline import Pipeline
from chatframe.schema import Settings
from chatframe.sources import records
from chatframe.sources.exports import chat_name, fold_lines, header_time, parse_exports, read_lines, write_exports
from chatframe.streaming.live import clean_stream, session_stream

T0 = datetime(2024, 1, 1, 10)
MSG = "datetime timestamp_ntz, source_file string, sender string, line_no bigint"


def loop(rows, you, scope):
    rows = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], "c" + r[1] if r[1] is not None else "n", r[3]))
    out, last, depth, session = {}, {}, {}, Counter()
    key = (lambda r: r[1]) if scope == "chat" else (lambda r: None)
    for i, r in enumerate(rows):
        p = last.get(key(r))
        d = max(0.0, (r[0] - p[0]).total_seconds()) if p else 0.0
        brk = p is None or d > 3600 or r[1] != p[1]
        session[r[1]] += brk
        if p is None or r[2] != p[2]:
            depth[key(r)] = 0 if r[2] == you else depth.get(key(r), 0) + 1
        if p:
            out[p[3]][4] = p[2] != you and (r[0] - p[0]).total_seconds() > 86_400
        out[r[3]] = [d, brk, session[r[1]], depth[key(r)], False]
        last[key(r)] = r
    sizes, seen = Counter((r[1], out[r[3]][2]) for r in rows), Counter()
    for r in rows:
        k = (r[1], out[r[3]][2])
        seen[k] += 1
        out[r[3]].append("mid" if sizes[k] == 1 else "opener" if seen[k] == 1 else "closer" if seen[k] == sizes[k] else "mid")
    return out


@pytest.mark.parametrize("scope", ["global", "chat"])
def test_order_features_against_a_loop(spark, scope):
    rng, t, rows = random.Random(4), T0, []
    for i in range(500):
        t += timedelta(seconds=rng.choice([0, 1, 60, 3600, 3601, 9000, 86_400, 86_401, 900_000]))
        rows.append((t, rng.choice(["a", "b", "b", None]), rng.choice(["You", "P", "Q", None]), i))
    rows.append((None, "a", "P", 1000))
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], MSG + ", _us int, session_id string")
    out = order_features(df, "You", scope, slice_rows=40)
    assert out.columns[:5] == ["datetime", "source_file", "sender", "line_no", "_us"]
    got = {r["line_no"]: [r["timedelta_prev"], r["session_break"], r["session_id"], r["reply_chain_depth"], r["ghosted"], r["position"]] for r in out.collect()}
    assert got == loop(rows, "You", scope)


def test_no_slice_holds_a_busy_day(spark):
    # nine tenths of the rows in one minute of ten years
    times = spark.range(20_000).selectExpr("if(id % 10 = 0, id * 15768000000, 100000000000000 + id * 3000) as _us")
    s = time_slices(times, "_us", 500)
    got = times.select("_us", s.of(F.col("_us")).alias("s")).orderBy("_us").collect()
    assert max(Counter(r["s"] for r in got).values()) <= 500 and [r["s"] for r in got] == sorted(r["s"] for r in got)
    assert time_slices(times.limit(0)).of_cell == (0,)


def test_depth_example_and_empty(spark):
    rows = [(T0 + timedelta(minutes=i), "a", s, i) for i, s in enumerate(["You", "A", "A", "B", "You", "B"])]
    got = order_features(spark.createDataFrame(rows, MSG), "You").orderBy("line_no").collect()
    assert [r["reply_chain_depth"] for r in got] == [0, 1, 1, 2, 0, 1]
    assert order_features(spark.createDataFrame([], MSG), "You").count() == 0
    with pytest.raises(ValueError):
        order_features(spark.createDataFrame([], MSG), "You", "all")


def test_contexts(spark):
    rows = [("abc", "Rahul Chat", 1, T0, "Rahul", "hi", 1), ("abc", "Rahul Chat", 1, T0 + timedelta(minutes=1), "You", "yo", 2), ("abc", "Rahul Chat", 2, T0 + timedelta(days=2), "You", "new session", 3)]
    df = spark.createDataFrame(rows, "conversation_id string, source_file string, session_id bigint, datetime timestamp_ntz, sender string, text string, line_no bigint")
    got = context_windows(df, "You").orderBy("datetime").collect()
    assert [(r["context"], r["reply"], r["recipient_name"]) for r in got] == [("Rahul: hi", "yo", "Rahul"), ("(start of conversation)", "new session", "unknown")]
    assert [r["context"] for r in context_windows(df, "You", 0).collect()] == ["(start of conversation)"] * 2
    assert context_windows(df.limit(0), "You").count() == 0
    text = context_windows(df, "You").select(chatml("You").alias("t"), "context", "reply").first()
    assert text["t"].startswith("<|im_start|>system\nYou are replicating You's") and "Position: mid]\n<|im_end|>\n<|im_start|>assistant\n" in text["t"]
    back = spark.createDataFrame([(text["t"],)], "t string").select(evaluation.user_content(F.col("t")).alias("u"), evaluation.true_reply(F.col("t")).alias("r")).first()
    assert back["r"] == text["reply"] and back["u"].startswith(text["context"] + "\n[Relationship: acquaintance | Hour: 12")


def test_context_frame_crosses_slices(spark):
    rows = [("c", T0 + timedelta(hours=20 * i), "You" if i == 9 else f"P{i}", f"t{i}", i) for i in range(10)]
    df = spark.createDataFrame(rows, "conversation_id string, datetime timestamp_ntz, sender string, text string, line_no bigint")
    got = context_windows(df, "You", 5, slice_s=3600).first()
    assert got["context"] == "\n".join(f"P{i}: t{i}" for i in range(4, 9)) and got["recipient_name"] == "P8"


def test_prompt_and_running_context(spark):
    df = spark.range(1).select(prompt(F.array(F.lit("a: b")), F.lit("family"), "Me", F.lit("2024-01-05 22:10:00").cast("timestamp_ntz")).alias("p"), prompt(F.lit(None).cast("array<string>"), F.lit("x"), "Me", F.lit("2024-01-05 22:10:00").cast("timestamp_ntz")).alias("q"), append_context(F.array(*(F.lit(str(i)) for i in range(10))), F.lit("new")).alias("c"), append_context(F.array(F.lit("0")), F.lit("new")).alias("s"))
    r = df.first()
    assert "a: b\n[Relationship: family | Hour: 22 | Day: Friday]\n<|im_end|>\n<|im_start|>assistant\n" in r["p"] and "(start of conversation)" in r["q"]
    assert r["c"] == [*map(str, range(1, 10)), "new"] and r["s"] == ["0", "new"]


def test_contacts(spark):
    book = Contacts.of([("Rahul", "+91 1", "best_friend"), ("Ankit Rao", "+91 2", "family"), ("An", "+91 3", "colleague"), (" rahul ", "+91 9", "close_friend"), ("", "x", "y")], [("College Group", "group_close")], "stranger")
    rows = [("Rahul", "Rahul Chat"), ("You", "Rahul Chat"), ("ankit", "x"), ("Zed", "my college group 1"), ("Zed", "zed"), (None, None), ("", ""), ("rahul", "ankit rao")]
    got = [(r["recipient_phone"], r["relationship"]) for r in tag_relationships(spark.createDataFrame(rows, "sender string, source_file string"), book).collect()]
    assert got == [("+91 9", "close_friend"), ("+91 9", "close_friend"), ("+91 2", "family"), ("group", "group_close"), ("unknown", "stranger"), ("unknown", "stranger"), ("unknown", "stranger"), ("+91 9", "close_friend")]
    df = spark.createDataFrame(rows, "sender string, source_file string").withColumn("relationship", F.lit("old"))
    assert {r["relationship"] for r in tag_relationships(df, Contacts()).collect()} == {"acquaintance"}


@pytest.mark.parametrize(("n", "test", "val"), [(9, 0, 0), (10, 1, 1), (20, 1, 2), (40, 2, 4), (60, 3, 6), (100, 5, 10), (279, 13, 27)])
def test_split_sizes(spark, n, test, val):
    df = spark.range(n).select(F.col("id"), F.lit("family").alias("relationship"), F.lit(1).alias("_r"), F.lit("old").alias("split"))
    rows = split.stratified_split(df, "relationship", "id").collect()
    c = Counter(r["split"] for r in rows)
    assert (len(rows), c["test"], c["val"]) == (n, test, val) and {r["_r"] for r in rows} == {1}


def test_split_edges(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "id int, relationship string")
    assert [r["split"] for r in split.stratified_split(df, "relationship", "id").collect()] == ["train"] * 3
    assert split.stratified_split(df.limit(0), "relationship", "id").count() == 0
    replies = spark.createDataFrame([("a",), ("ab",), ("x" * 500,), ("x" * 501,), (None,)], "reply string")
    assert split.reply_length(replies).count() == 2
    assert [r["id"] for r in split.shuffled(spark.range(20), "id").collect()] == [r["id"] for r in split.shuffled(spark.range(20).repartition(7), "id").collect()]


LINES = {
    "Rahul Chat": ["15/03/2024, 22:14 - Messages and calls are end-to-end encrypted", "15/03/2024, 22:15 - Rahul: first line", "still same message", "", "15/03/2024, 22:16 - You: <Media omitted>"],
    "b": ["lost", "15/03/2024, 22:14 - A: i left home", "gone too", "31/02/2024, 9:15 - A: never", "no", "1/2/2024, 10:15 pm - A: ", "tail", "15/03/2024, 22:20 - A:", "15/03/2024,22:21- A: b: c", "this message was deleted", "15/03/2024, 22:14 - ~: x", "15/03/2024, 22:30 - B joined"],
}


def test_fold(spark):
    lines = spark.createDataFrame([(f, i, s) for f, ls in LINES.items() for i, s in enumerate(ls)], "source_file string, pos int, line string")
    got = {(r["source_file"], r["line_no"]): r for r in fold_lines(lines).collect()}
    assert {k: (r["sender"], r["text"], r["is_media"]) for k, r in got.items()} == {
        ("Rahul Chat", 1): ("Rahul", "first line still same message", False), ("Rahul Chat", 4): ("You", "<Media omitted>", True),
        ("b", 5): ("A", " tail 15/03/2024, 22:20 - A:", False), ("b", 8): ("A", "b: c this message was deleted", False),
    }
    assert got[("b", 5)]["datetime"] == datetime(2024, 2, 1, 22, 15)
    assert "joined" not in "".join(r["text"] for r in fold_lines(lines, drop_headerless_notices=True).collect())
    assert fold_lines(lines.limit(0)).count() == 0
    assert sorted(map(tuple, fold_lines(lines, slice_lines=2).collect())) == sorted(map(tuple, got.values()))
    odd = fold_lines(spark.createDataFrame([("f", 0, "1/2/2024, 10:15\u202fpm - A: x\u00a0y")], "source_file string, pos int, line string")).first()
    assert (odd["datetime"], odd["text"]) == (datetime(2024, 2, 1, 22, 15), "x y")


@pytest.mark.parametrize(("d", "t", "want"), [
    ("05/12/2024", "9:15", datetime(2024, 12, 5, 9, 15)), ("12/15/2024", "9:15", datetime(2024, 12, 15, 9, 15)), ("31/02/2024", "9:15", None), ("1/2/68", "9:15", datetime(2068, 2, 1, 9, 15)),
    ("1/2/69", "9:15", datetime(1969, 2, 1, 9, 15)), ("1/2/024", "9:15", None), ("1/2/2024", "10:15 pm", datetime(2024, 2, 1, 22, 15)), ("1/2/2024", "10:15PM", None),
    ("1/2/2024", "12:05 AM", datetime(2024, 2, 1, 0, 5)), ("1/2/2024", "0:05 AM", None), ("1/2/2024", "22:14 PM", None), ("1/2/2024", "24:00", None),
])
def test_header_times(spark, d, t, want):
    assert spark.range(1).select(header_time(F.lit(d), F.lit(t)).alias("x")).first()["x"] == want


def test_exports_and_pipeline(spark, tmp_path):
    day = lambda i: (T0 + timedelta(minutes=i)).strftime("%d/%m/%Y, %H:%M")
    (tmp_path / "raw").mkdir()
    for name, who in (("Rahul 50%.v2.txt", "Rahul"), ("Asha+1.txt", "Asha")):
        text = "﻿" + "\n".join(f"{day(i)} - {'You' if i % 2 else who}: message number {i}" for i in range(30))
        (tmp_path / "raw" / name).write_text(text, encoding="utf-8")
    (tmp_path / "raw" / "bad.txt").write_bytes(b"01/01/2024, 10:00 - A: caf\xe9 x")
    parsed = parse_exports(spark, str(tmp_path / "raw"))
    assert {r["source_file"] for r in parsed.select("source_file").distinct().collect()} == {"Rahul 50%.v2", "Asha+1", "bad"}
    assert "�" in parsed.where("source_file = 'bad'").first()["text"]
    assert read_lines(spark, str(tmp_path / "raw"), keep_bom=True).where("pos = 0").count() == 3
    out = Pipeline(spark, Settings(scope="chat"), Contacts.of([("Rahul", "1", "family")])).run(str(tmp_path / "raw"), str(tmp_path / "out"), T0 + timedelta(days=30))
    with pytest.raises(ValueError, match="cutoff"):  # by default what is older than 24 months of 30 days before now goes
        Pipeline(spark).run(str(tmp_path / "raw"), str(tmp_path / "old")) if T0 < datetime.now() - timedelta(days=721) else Pipeline(spark).run(str(tmp_path / "raw"), str(tmp_path / "old"), T0 + timedelta(days=9999))
    # the owner's equal messages of the same minute in two chats count once
    assert out.count() == 15 and {"train", "val", "test"} >= {r["split"] for r in out.collect()}
    assert records.read_samples(spark, str(tmp_path / "out" / "train.jsonl")).count() == out.where("split = 'train'").count()
    counts = {r["split"]: r["n_lines"] for r in records.line_counts(spark, str(tmp_path / "out" / "*.jsonl")).collect()}
    assert sum(counts.values()) == 15
    with pytest.raises(FileNotFoundError):
        parse_exports(spark, str(tmp_path / "out"))


def test_many_export_files(spark, tmp_path):
    """A file per chat without a step of the driver per file, read back in few tasks; names that no file can have come back."""
    names = [f"chat {i}" for i in range(300)] + ["a/b", "a:b", "_x", ".y", "50%2F", "%5Fz", "किताब+1", "", "v.2"]
    lines = lambda some: spark.createDataFrame([(n, k, f"0{1 + k}/01/2024, 10:00 - Asha: {n} {k}") for n in some for k in (2, 0, 1)], "source_file string, pos bigint, line string")
    at, calls, send = str(tmp_path / "out"), [], spark._jvm._gateway_client.send_command

    def asked(df, to):
        """The calls to the JVM that writing and planning the reading take, without those of releasing objects; the messages."""
        calls.clear()
        write_exports(df, to)
        read = parse_exports(spark, to, check=False)
        return sum(not c.startswith("m") for c in calls), read

    ten, all_ = lines(names[:10]), lines(names)
    spark._jvm._gateway_client.send_command = lambda c, *a, **k: calls.append(c) or send(c, *a, **k)
    try:
        few, _ = asked(ten, str(tmp_path / "few"))
        many, got = asked(all_, at)
    finally:
        del spark._jvm._gateway_client.send_command
    assert many < few + len(names), (few, many)
    assert len([f for f in os.listdir(at) if f.endswith(".txt")]) == len(names) == len(os.listdir(at))
    assert (tmp_path / "out" / "chat 7.txt").read_text() == "".join(f"0{1 + k}/01/2024, 10:00 - Asha: chat 7 {k}\n" for k in range(3))
    assert sorted((r["c"], r["text"]) for r in got.select(chat_name(F.col("source_file")).alias("c"), "text").collect()) == sorted((n, f"{n} {k}".strip()) for n in names for k in range(3))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        assert read_lines(spark, at).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("naïve 👍\n\"q\"",), ("b",), (None,)], "text string")
    assert records.write_samples(df, str(tmp_path / "a.jsonl"), files=1) and not records.write_samples(df.limit(0), str(tmp_path / "none.jsonl"))
    assert {r[0] for r in records.read_samples(spark, str(tmp_path / "a.jsonl")).collect()} == {"naïve 👍\n\"q\"", "b"} and not (tmp_path / "none.jsonl").exists()
    assert records.read_splits(spark, {"train": str(tmp_path / "a.jsonl")}).columns == ["text", "split"]
    ev = spark.createDataFrame([(0, "g", "c", "t")], "id bigint, generated string, context_preview string, true_preview string")
    records.write_evaluation(ev, str(tmp_path / "e.json"))
    assert records.read_evaluation(spark, str(tmp_path / "e.json")).first()["generated"] == "g"
    import pandas as pd

    pd.DataFrame({"datetime": pd.to_datetime(["2024-01-01 10:00:00.000001"]), "text": ["x"]}).astype({"datetime": "datetime64[ns]"}).to_parquet(tmp_path / "n.parquet")
    assert records.read_stage(spark, str(tmp_path / "n.parquet")).first()["datetime"] == datetime(2024, 1, 1, 10, 0, 0, 1)
    (tmp_path / "w.txt").write_text("The  a\nthe")
    (tmp_path / "w.json").write_text(json.dumps({"x": [" A ", "", "b"]}))
    assert records.read_words(str(tmp_path / "w.txt")) == ("the", "a") and records.read_word_lists(str(tmp_path / "w.json")) == {"x": ("a", "b")} and records.read_words("/nowhere", ("d",)) == ("d",)
    assert "although" in records.read_words(None) and set(records.read_word_lists(None)) == {"english", "hinglish", "hindi"}
    work = tmp_path / "work"
    work.mkdir()
    (work / "big.txt").write_text("x" * 10)
    (work / ".gitkeep").write_text("")
    assert records.folder_sizes(spark, str(tmp_path / "a.jsonl")).first()["n_files"] >= 1
    assert records.purge(spark, [str(work)]) == 10 and (work / "big.txt").exists()
    assert records.purge(spark, [str(work)], dry_run=False, confirm=lambda n: n == 10) == 10 and os.listdir(work) == [".gitkeep"]


def test_dedup_and_cutoff(spark):
    rows = [(T0, "a", "x", "f2", 1), (T0, "a", "x", "f1", 2), (T0, None, "x", "f1", 3), (T0, None, "x", "f1", 4), (None, "a", "x", "f", 1)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, sender string, text string, source_file string, line_no int")
    assert sorted((r["source_file"], r["line_no"]) for r in dedup_messages(df).collect()) == [("f", 1), ("f1", 2), ("f1", 3)]
    assert cutoff(df, 0, None).count() == 5 and cutoff(df, 1, "2024-01-31 10:00:00").count() == 4 and cutoff(df, 1, "2024-01-31 10:00:01").count() == 0


def test_reports(spark):
    rows = [(T0, "f", "You", "hello", False), (T0 + timedelta(hours=3), "g", "B", "x 👍", True), (T0 + timedelta(hours=3), "g", "B", None, False), (None, None, None, "zz", False)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, source_file string, sender string, text string, is_media boolean")
    assert tuple(stats.corpus_stats(df).first()) == (4, date(2024, 1, 1), date(2024, 1, 1), 2, 1)
    assert [tuple(r) for r in stats.with_bar(stats.value_counts(df, "sender"), 4).orderBy(F.desc("n_messages"), "sender").collect()] == [("B", 2, "████"), (None, 1, "██"), ("You", 1, "██")]
    assert [tuple(r) for r in stats.top_hours(df).collect()] == [(13, "1 PM", 2), (10, "10 AM", 1)]
    assert stats.share_of_total(df, "sender").where("sender = 'B'").first()["percent"] == 50.0
    assert tuple(stats.size_verdict(spark.range(3000)).first()) == (3000, "usable") and stats.size_verdict(spark.range(0)).first()["verdict"] == "small"
    assert [r["preview"] for r in stats.recent_messages(df, 3, "text").collect()] == ["hello", "[DROPPED]", "x 👍"]  # the oldest of them first
    unchanged = stats.cleaning_preview(df.where("text = 'hello'"), F.col("text"), 5, "text")
    assert [r["changed"] for r in unchanged.collect()] == [False]
    assert tuple(stats.cleaning_effect(df, F.lit(None).cast("string")).first()) == (4, 3, 4)
    assert stats.corpus_stats(df.limit(0)).first()["n_messages"] == 0


def test_evaluation(spark):
    s = spark.createDataFrame([(1, "<|im_start|>user\nA: hi there my friend\n[meta]\n<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>"), (2, "no markers"), (3, None)], "n int, text string")
    got = evaluation.eval_samples(s, 10, "n", raw=True).collect()
    assert [(r["id"], r["context_preview"], r["true_preview"], r["true"]) for r in got] == [(0, "A: hi there ...", "yo", "yo")] and got[0]["prompt"].endswith("<|im_start|>assistant\n")
    assert evaluation.generate(evaluation.eval_samples(s), lambda ps: ["r"] * len(ps)).first()["generated"] == "r"
    lines = spark.createDataFrame([("a",), ("a\nb\n[m]",), ("a\n[x]\n[m]",), ("[x]\n[m]",)], "c string")
    assert [r[0] for r in lines.select(evaluation.last_context_line(F.col("c"))).collect()] == ["a", "b", "a", "..."]
    pairs = spark.createDataFrame([("abcd", "ab👍"), (None, "")], "true string, generated string")
    r = evaluation.eval_summary(pairs).first()
    assert (r["true_length"], r["generated_length"], r["generated_emoji_rate"], r["in_band"]) == (2.0, 1.5, 0.5, True)
    assert evaluation.eval_summary(pairs.limit(0)).first()["length_ratio"] == 0.0


def test_streams(spark, tmp_path):
    rows = [("a", T0, 1, "hi  there"), ("a", T0 + timedelta(hours=1), 2, "<Media omitted>"), ("a", T0 + timedelta(hours=1), 2, "<Media omitted>"), ("a", T0 + timedelta(hours=3), 3, "xx"), ("b", T0, 4, "yy"), ("z", T0 + timedelta(days=9), 5, "zz")]
    spark.createDataFrame(rows, "source_file string, ts timestamp, msg_id bigint, text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("source_file string, ts timestamp, msg_id bigint, text string").parquet(str(tmp_path / "in"))
    for name, df, mode in (("cleaned", clean_stream(stream), "append"), ("closed", session_stream(stream), "append")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("cleaned").count() == 4
    assert sorted((r["source"], r["n_messages"]) for r in spark.table("closed").collect()) == [("a", 1), ("a", 2), ("b", 1)]
