"""Training-data operators against brute force, round trips, held-out accuracy, and their hard cases."""

import pickle
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatframe.llm import abuse, conversations, groups, languages, overlap, packing, personal, tokens

T0 = datetime(2024, 1, 1, 10)
ENRICHED = "msg_id bigint, conversation_id string, line_no bigint, datetime timestamp_ntz, sender string, text string"


@pytest.fixture(scope="module")
def owners(spark):
    return spark.createDataFrame([("You",), ("Tavi (me)",), (None,)], "name string")


def chats(spark):
    m, rows = 0, []
    for cid, said in {
        "kept": [("B", "hi"), ("You", "yo"), ("B", None), ("~", "<Media omitted>")],
        "spelt": [("B", "hi"), ("‎ta​vi (ME) ", "yo")],
        "unanswered": [("You", "yo"), ("B", "hi"), ("You", "Missed voice call"), ("You", "‎image omitted")],
        "empty": [("B", "​"), ("You", "This message was deleted."), ("B", " ")],
        "no speaker": [("B", "hi"), ("You", "yo"), ("~", "x")],
        "only owner": [("You", "yo")],
        "talks of notices": [("B", "i missed your call, was at the gym"), ("You", "the photo was omitted from the vase")],
    }.items():
        for i, (who, text) in enumerate(said):
            m += 1
            rows.append((m, cid, i, T0 + timedelta(minutes=i), who, text))
    rows += [(900, None, 1, T0, "B", "x"), (901, "no time", 1, None, "B", "x"), (902, "no time", 2, T0, "You", "y"), (903, "tie", 5, T0, "B", "x"), (904, "tie", 5, T0, "You", "y"), (905, "tie2", 1, T0, "B", "x"), (906, "tie2", 2, T0, "You", "y")]
    return spark.createDataFrame(rows + rows[:7], ENRICHED)


def test_verdicts(spark, owners):
    v = {r["conversation_id"]: r["status"] for r in conversations.verdicts(conversations.messages(chats(spark), owners)).collect()}
    assert v == {"kept": "kept", "spelt": "kept", "unanswered": "unanswered", "empty": "empty", "no speaker": "broken", "only owner": "unanswered", "talks of notices": "kept", "no time": "broken", "tie": "unanswered", "tie2": "kept"}
    assert conversations.verdicts(conversations.messages(chats(spark).limit(0), owners)).count() == 0


def test_turns(spark, owners):
    rows = [(i, "c", i, T0 + timedelta(minutes=m), who, f"t{i}") for i, (m, who) in enumerate([(0, "B"), (1, "B"), (2, "You"), (3, "B"), (3000, "B"), (3001, "You"), (3002, "You"), (9000, "You")])]
    turns = conversations.rebuild(spark.createDataFrame(rows + rows[:2], ENRICHED), owners, slice_s=3600).orderBy("turn_no").collect()
    assert [(r["session_no"], r["role"], r["text"], r["n_messages"]) for r in turns] == [(1, "contact", "t0\nt1", 2), (1, "owner", "t2", 1), (1, "contact", "t3", 1), (2, "contact", "t4", 1), (2, "owner", "t5\nt6", 2)]
    assert conversations.rebuild(spark.createDataFrame([], ENRICHED), owners).count() == 0


def test_gaps_across_midnight_count(spark):
    hole, day, rows = 154, 86_400_000_000, []
    for b in range(94, 168):  # a gap in every bin but five; those of more than eight hours run across midnight
        if abs(b - hole) > 2:
            gap = int(2 ** ((b + 0.5) / 10) * 1e6)
            start = 600_000_000 if gap < day // 3 else day - 3_600_000_000
            rows += [(b, f"c{b}", 1, start), (b + 1000, f"c{b}", 2, start + gap)]
    said = spark.createDataFrame([*rows, (1, "n", 1, None)], "msg_id bigint, conversation_id string, line_no bigint, at_us bigint")
    assert conversations.gap_limits(said).collect()[0]["gap_us"] == int(2 ** ((hole + 0.5) / 10) * 1e6)


def test_components_of_a_long_chain(spark):
    pairs = [(f"n{i:03}", f"n{i + 1:03}") for i in range(90)] + [("x", "y"), ("z", "z"), (None, "q"), ("x", "y")]
    random.Random(1).shuffle(pairs)
    got = {r["id"]: r["group_id"] for r in groups.components(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert got == {f"n{i:03}": "n000" for i in range(91)} | {"x": "x", "y": "x", "z": "z"}
    assert groups.components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_phone_keys(spark):
    cases = {"+91 60000 43489": "6000043489", "0091 6000 043 489": "6000043489", "६००००४३४८९": "6000043489", "12345": None, "0000000000": None, "group": None, "": None, None: None, "٦٠٠٠٠٤٣٤٨٩": "6000043489"}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, p string")
    assert [r["k"] for r in df.select("i", groups.phone_key(F.col("p")).alias("k")).orderBy("i").collect()] == list(cases.values())


def test_grouped_split(spark):
    rng, rows = random.Random(2), []
    for c in range(400):
        phone = f"60000{c // 2:05}" if c % 3 else None
        for _ in range(rng.choice([1, 2, 5, 20])):
            rows.append((len(rows), f"c{c}", phone, rng.choice(["family", "family", "friend", None])))
    rows += [(len(rows) + i, "hot", None, "family") for i in range(1500)] + [(10_000, None, None, "friend")]
    df = spark.createDataFrame(rows + rows[:5], "sample_id bigint, conversation_id string, recipient_phone string, relationship string")
    g = groups.conversation_groups(df)
    out = groups.grouped_split(df, g).cache()
    assert out.count() == len(rows) and out.groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    share = {r["split"]: r["count"] / len(rows) for r in out.groupBy("split").count().collect()}
    assert all(abs(share[s] - want) < 0.02 for s, want in groups.SPLITS.items()), share
    even = df.where("conversation_id <> 'hot'")  # where no group outweighs a split's share
    for r in groups.grouped_split(even, g).groupBy("relationship").agg(*(F.avg((F.col("split") == x).cast("int")).alias(x) for x in groups.SPLITS)).collect():
        assert all(abs(r[x] - want) < 0.05 for x, want in groups.SPLITS.items()), r
    assert groups.wholeness(out).first().asDict() == {"n_records": len(rows), "n_twice": 0, "n_torn": 0}
    assert groups.grouped_split(df.limit(0), g).count() == 0


def test_blocks_of_groups_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK", 30)
    df = spark.range(2000).selectExpr("id as sample_id", "concat('c', id % 300) as conversation_id", "cast(null as string) as recipient_phone", "'x' as relationship")
    g = groups.conversation_groups(df)
    a, b = (sorted(map(tuple, groups.grouped_split(d, g, most_items=100).collect())) for d in (df, df.repartition(9)))
    assert a == b and len(a) == 2000


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 6))
def test_differencing_puts_every_item_into_a_bin(weights, bins):
    got = groups._difference([float(w) for w in weights], bins)
    assert len(got) == len(weights) and all(0 <= b < bins for b in got)
    sums = [sum(w for w, b in zip(weights, got) if b == k) for k in range(bins)]
    if weights:
        assert max(sums) <= sum(weights) / bins + max(weights)


def test_encoding_equals_the_public_encoder_and_round_trips(spark):
    import tiktoken

    c = tokens.codec(tokens.vocabulary_path())
    plain = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    rng = random.Random(0)
    texts = ["", None, "hello world", "<|endoftext|> a", "नमस्ते 👨‍👩‍👧\r\n\t x", "it's we'll 12345", "\x00​﻿", " " * 50, "é" * 20_000, "▁ <unk> ▁"]
    texts += ["".join(rng.choice("ab \n'sतé👍　.,0") for _ in range(200)) for _ in range(50)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, key string")
    ids = {r["doc_id"]: r["ids"] for r in tokens.encode(df).collect()}
    assert all(ids[i] == (plain.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    back = {r["doc_id"]: r["text"] for r in tokens.decode(tokens.encode(df)).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.lengths(df).collect()} == {i: len(x) for i, x in ids.items()}
    assert tokens.encode(df.limit(0)).count() == 0


def test_packing(spark):
    rng = random.Random(3)
    sizes = [(i, rng.choice([1, 7, 100, 400, 900, 2048, 5000, 0, None])) for i in range(3000)]
    rows = packing.pack(spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint").repartition(6)).collect()
    bins, docs = defaultdict(int), defaultdict(list)
    for r in rows:
        bins[r["container_id"]] += r["n"]
        docs[r["doc_id"]].append((r["start"], r["n"]))
    total = sum(n or 0 for _, n in sizes)
    assert max(bins.values()) <= 2048 and total / (len(bins) * 2048) > 0.98
    for i, n in sizes:
        at = 0
        for start, k in sorted(docs.get(i, [])):
            assert start == at and (len(docs[i]) == 1 or n > 2048)
            at += k
        assert at == (n or 0)
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0


def test_packing_leaves_no_task_with_all_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(packing, "cut", lambda df: seen.append(df.count()) or df.cache())
    sizes = spark.range(4000).selectExpr("id as doc_id", "cast(if(id = 7, 10, 1229) as bigint) as n_tokens").repartition(16)
    rows = packing.pack(sizes).collect()
    assert len(rows) == 4000 and len({r["container_id"] for r in rows}) == 3999
    assert seen[0] == 3999 and max(seen[1:]) <= 4  # later rounds hold only what can gain
    assert packing.helped({1229: 100, 10: 1}, 2048) == {10: 1.0, 1229: 0.01}


def test_packing_totals(spark):
    sizes = spark.createDataFrame([(1, 5000), (2, 40), (3, 2048), (4, 0), (5, None)], "doc_id bigint, n_tokens bigint")
    assert packing.totals(packing.pack(sizes), sizes).first().asDict() == {"n_items": 3, "n_cut": 0, "n_wrong": 0, "n_overfull": 0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 20 for b in bins)


def test_personal_information(spark):
    f = personal.Finder(["Nilora Velmani", "Elsavi Hulstrom"])
    cases = {
        "mail it to a.b+c@mail.example.org please": ["email"], "info.x @ example.co.test or y＠example.com": ["email", "email"], "reach me at klo at mail dot example": ["email"], "q [at] example [dot] org": ["email"],
        "tag @weekend_gang, meet @ the gate at 21:00, user @ Ombra wifi": [], "call +91 60000 43489 or (059) 5550 0488": ["phone", "phone"], "६०५८८९९६६८": ["phone"],
        "ring six zero seven four two zero two seven seven nine": ["phone"], "booking ref 6263247997, pnr 1361905864, order 123456": [], "it costs Rs 29,108,000 on 15-18-2023": [],
        "id 4505-8413-4976, PAN WACDC8206C, ssn 971-28-8641, TH60 20136118553, KM 93 72 32 B": ["id_number"] * 5, "invoice no. INV-6792-342424, TRK14873812, https://chat.example/t/17882490": [],
        "come to 186 Pellgate Road, Brimsted": ["address"], "Mareviaweg 185, 68266 Velgaon": ["address"], "Calle Thornvale 74, 2º B, Dhalpur": ["address"], "Flat 13D, Rasvani Lane, Sarovela 394056": ["address"],
        "house 18, Sarovel Marg, near the tank, Ostmere - 165165": ["address"], "H.No. 17-8/239, Ombra Nagar, Lindhaven": ["address"], "the shop on Kesari Road is closed, sector 78, page 765, line 59": [],
        "ask NILORA velmani and Dr. Hulstrom, Nilora is late, the Velmani Bridge": ["person", "person"], "Elsavi R. Hulstrom": ["person"], "please ask Jonathan Mercer about it, and tell Ann-Marie O. Keller": ["person", "person"], "meet Monday March the first, ask Silver Lake or Kesari Road": [],
        f"mail a.b@{'sub.' * 40}example.org now": ["email"], f"write to klo at mail {'dot sub ' * 60}dot example": ["email"], "": [], None: [], "x" * 100_000: [],
    }
    for text, want in cases.items():
        assert [k for *_, k in f.items(text)] == want, text
    long = f"mail a.b@{'sub.' * 40}example.org now"
    assert f.items(long) == [(5, len(long) - 4, "email")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] + [(0, next(iter(cases)))], "msg_id bigint, text string")
    names = ("Nilora Velmani", "Elsavi Hulstrom")
    assert personal.find(df, names).count() == sum(map(len, cases.values()))
    out = [r["text"] for r in personal.redact(df, names).where("msg_id < 3").distinct().collect()]
    assert "mail it to [EMAIL] please" in out
    assert personal.find(df.limit(0), names).count() == 0


def test_accepted_forms_open_windows():
    f = personal.Finder(["Nilora Velmani"])
    forms = [(f"12 Baker {w}", "address") for w in personal.STREETS.split()] + [("45 MG Rd, Pune", "address"), ("7 Park Ln.", "address"), ("flat 7, Baker St", "address")]
    forms += [(f"Haupt{w}{dot} 12", "address") for w in personal.GERMAN_STREETS.split() for dot in ("", ".") if w + dot != "ring."]
    forms += [(f"{w} Thornvale 74", "address") for w in personal.ROMANCE_STREETS.split()]
    digits = "nine eight seven six five four three two one zero".split()
    forms += [(sep.join(digits), "phone") for sep in (" ", "-", ", ", ",", " - ")]
    for text, kind in forms:
        assert [k for *_, k in f.items(text)] == [kind], text
    for text in ("12 Baker stops", "7 Park lnx", "the 21 st", "nine, eight and ten", "it looked boring. 35 people came"):
        assert f.items(text) == [], text


def test_disguises():
    assert abuse.words("D.U.M.B naaaked w@nk3r p r i c k хаs 77") [:2] == ["dumb", "naked"]
    assert {"wanker", "prick", "0"} <= set(abuse.words("D.U.M.B naaaked w@nk3r, p r i c k хаs 77"))
    assert abuse._near("m*ron", "moron") and abuse._near("mron", "moron") and abuse._near("mroon", "moron") and not abuse._near("baron", "moron")


def test_abuse_on_held_out_texts(spark):
    rng = random.Random(6)
    insult = lambda: f"{rng.choice(['you are a', 'what a', 'get lost you'])} {rng.choice(['blorp', 'snark', 'grimp'])}"
    clean = lambda: f"{rng.choice(['please bring', 'i saw', 'we need', 'what a'])} the {rng.choice(['lamp', 'book', 'car', 'tea', 'sofa'])} {rng.choice(['today', 'later', 'again'])}"
    make = lambda n, share: [(f"{clean()}. {insult()}", 1) if rng.random() < share else (clean(), 0) for _ in range(n)]
    train = make(1500, 0.2)
    noisy = [(t, 1 - y if rng.random() < 0.03 else y) for t, y in train]
    model = abuse.fit(noisy, [t for t, _ in make(2000, 0.05)], ["blorp"])
    held = make(800, 0.3)
    hits = [model.score(t) >= model.threshold for t, _ in held]
    tp = sum(h and y for h, (_, y) in zip(hits, held))
    assert tp / sum(hits) > 0.95 and tp / sum(y for _, y in held) > 0.95
    assert model.score(None) == model.score("") == 0.0
    df = spark.createDataFrame([(1, held[0][0], 0.5), (2, None, None)], "msg_id bigint, text string, score double")
    assert abuse.score(df, model).count() == 2 and abuse.score(df.limit(0), model).count() == 0
    assert abuse.fit([], [], []).score("x") < 0.5


def test_abuse_beyond_a_tenth_of_the_messages():
    rng = random.Random(6)
    insult = lambda: f"{rng.choice(['you are a', 'what a', 'get lost you'])} {rng.choice(['blorp', 'snark', 'grimp'])}"
    clean = lambda: f"{rng.choice(['please bring', 'i saw', 'we need', 'what a'])} the {rng.choice(['lamp', 'book', 'car', 'tea', 'sofa'])} {rng.choice(['today', 'later', 'again'])}"
    make = lambda n, share: [(f"{clean()}. {insult()}", 1) if rng.random() < share else (clean(), 0) for _ in range(n)]
    for judged, share in ((1500, 0.4), (200, 0.4), (600, 0.6)):
        noisy = [(t, 1 - y if rng.random() < 0.03 else y) for t, y in make(judged, 0.25)]
        model = abuse.fit(noisy, [t for t, _ in make(2000, share)], ["blorp"])
        held = make(1000, share)
        hits = [model.score(t) >= model.threshold for t, _ in held]
        tp = sum(h and y for h, (_, y) in zip(hits, held))
        assert tp / sum(hits) > 0.9 and tp / sum(y for _, y in held) > 0.9, (judged, share)


def brute(rows):
    import re

    out, sets = set(), {}
    for i, s, t in rows:
        if t:
            u = re.search(r"(?s)<\|im_start\|>user\n(.*?)<\|im_end\|>", t)
            lines = u[1].rstrip("\n").split("\n") if u else []
            a = re.search(r"(?s)<\|im_start\|>assistant\n?(.*?)(?:<\|im_end\|>|$)", t)
            w = set(re.findall(r"[^\W_]+", ("\n".join(lines[:-1] if lines and lines[-1].startswith("[") else lines) + "\n" + (a[1] if a else "")).lower()))
            if len(w) >= 20:
                sets[i] = s, w
    for a, (s, x) in sets.items():
        for b, (t, y) in sets.items():
            if a < b and s != t and 10 * len(x & y) >= 7 * min(len(x), len(y)):
                out.add((a, b))
    return out


def test_contained_pairs(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}é" for i in range(90)]
    rows = []
    for i in range(160):
        ws = rng.sample(vocabulary, rng.randint(15, 60)) if i % 4 or not rows else rows[-1][3][: rng.randint(20, 60)]
        rows.append((i, rng.choice(["train", "train", "val", "test"]), None, list(ws)))
    recs = [(i, s, "f", f"<|im_start|>system\nsame words here\n<|im_end|>\n<|im_start|>user\n{' '.join(ws[:-3])}\n[Relationship: x | Hour: {i}]\n<|im_end|>\n<|im_start|>assistant\n{'  '.join(ws[-3:])}<|im_end|>") for i, s, _, ws in rows]
    recs += [(500, "test", None, None), (501, "val", None, ""), (502, "val", "f", "x " * 50_000)]
    df = spark.createDataFrame(recs, "sample_id bigint, split string, source_file string, text string")
    want = brute([(i, s, t) for i, s, _, t in recs])
    assert want
    for block in (4096, 32):
        got = [(r["id_a"], r["id_b"]) for r in overlap.contained_pairs(df, block=block).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert overlap.contained_pairs(df.limit(0)).count() == 0


def test_contained_pairs_blocks(spark):
    """Blocks are packed once and read where they meet, without a shuffle of copies; repeated rows give a pair once; words beyond those with a bit."""
    rng = random.Random(15)
    text = lambda ws: f"<|im_start|>user\n{' '.join(ws)}\n[m]\n<|im_end|>\n<|im_start|>assistant\nok<|im_end|>"
    said = [[f"w{rng.randint(0, 6000)}" for _ in range(rng.choice([19, 25, 40, 120]))] for _ in range(60)] + [[f"w{k}" for k in range(3000)]]
    for ws in said[:60]:
        said.append([w for w in ws if rng.random() < 0.8] + [f"w{rng.randint(0, 6000)}" for _ in range(rng.randint(0, 30))])
    rows = [(i, rng.choice(["train", "val", "test"]), "f", text(ws)) for i, ws in enumerate(said)]
    want = brute([(i, s, t) for i, s, _, t in rows])
    assert len(want) > 20
    df = spark.createDataFrame(rows + rows[:40] + [(i, s, None, t) for i, s, _, t in rows[60:]], "sample_id bigint, split string, source_file string, text string")
    pairs = overlap.contained_pairs(df, block=32)
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = [(r["id_a"], r["id_b"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_contained_copies(spark, monkeypatch):
    """Records that say the same, in any order of words, are compared as one and written out for each, in bounded batches."""
    rng = random.Random(21)
    text = lambda ws, hour: f"<|im_start|>user\n{' '.join(ws)}\n[Hour: {hour}]\n<|im_end|>\n<|im_start|>assistant\nok<|im_end|>"
    said = [rng.sample([f"w{k}" for k in range(70)], rng.choice([19, 25, 45])) for _ in range(12)]
    rows = [(12 * c + i, ("train", "train", "val", "test")[(c + i % 3) % 4], "f", text(ws, c)) for c in range(30) for i, ws in enumerate(said)]
    rows += [(900 + i, "val", "f", text(ws[::-1], 0)) for i, ws in enumerate(said)]
    want = brute([(i, s, t) for i, s, _, t in rows])
    df = spark.createDataFrame(rows + rows[:50], "sample_id bigint, split string, source_file string, text string")
    for block in (4096, 16):
        packed = []
        monkeypatch.setattr(overlap, "cut", lambda d, keep=overlap.cut: packed.append(keep(d)) or packed[-1])
        got = [(r["id_a"], r["id_b"]) for r in overlap.contained_pairs(df, block=block).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        # 19 words and "ok" are enough; the reversed records may lie in other blocks
        sets = [len(pickle.loads(r["rows"])[0][0]) for r in packed[-1].collect()]
        assert sum(sets) <= 24 and (block == 16 or sum(sets) == 12), sets
    start, ids = overlap._members(np.array([(2, 7), (0, 5), (2, 6), (0, 4)]), 4)
    assert start.tolist() == [0, 2, 2, 4, 4] and ids.tolist() == [4, 5, 6, 7]
    monkeypatch.setattr(overlap, "AT_ONCE", 3)
    some = [(x.tolist(), y.tolist()) for x, y in overlap._written((start, ids), np.array([0, 1, 2]), (start, ids), np.array([2, 0, 2]))]
    assert len(some) > 1 and [p for x, y in some for p in zip(x, y)] == [(4, 6), (4, 7), (5, 6), (5, 7), (6, 6), (6, 7), (7, 6), (7, 7)]


def test_found_of_union(spark, tmp_path, monkeypatch):
    """p7_found takes the share of the words that at least one of the two records has: one within a longer one is no case."""
    from chatframe.llm.queries import QUERIES

    text = lambda ws: f"<|im_start|>user\n{' '.join(ws)}\n[m]\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>"
    run = lambda a, b: text(f"w{k}" for k in range(a, b))
    # 28 of 40 words are exactly 70 %, 27 of 41 are less; 24 words within 40, 28 within 40
    tables = {"train": [(1, run(0, 34)), (2, None)], "val": [(3, run(6, 40)), (4, run(7, 41)), (5, run(100, 140))], "test": [(6, run(100, 124)), (7, run(100, 128)), (8, run(0, 19))]}
    for name, rows in tables.items():
        spark.createDataFrame([(i, t, "f") for i, t in rows + rows[:1]], "sample_id bigint, text string, source_file string").write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(tuple(r) for r in QUERIES["p7_found"](spark, str(tmp_path)).collect()) == [(1, 3), (5, 7)]

    rng = random.Random(31)
    said = [[f"w{k}" for k in rng.sample(range(400), rng.choice([19, 22, 40, 90, 200]))] for _ in range(60)]
    said += [[w for w in ws if rng.random() < 0.9] + [f"x{k}" for k in range(rng.randint(0, len(ws) // 3))] for ws in said for _ in range(3)]
    rows = [(i, rng.choice(["train", "val", "test"]), "f", text(ws)) for i, ws in enumerate(said)]
    sets = {i: (s, set(ws)) for (i, s, _, _), ws in zip(rows, said) if len(set(ws)) >= 20}
    want = {(a, b) for a, (s, x) in sets.items() for b, (t, y) in sets.items() if a < b and s != t and 10 * len(x & y) >= 7 * len(x | y)}
    assert 20 < len(want) < len(brute([(i, s, t) for i, s, _, t in rows]))
    df = spark.createDataFrame(rows, "sample_id bigint, split string, source_file string, text string")
    for block in (4096, 32):
        got = [(r["id_a"], r["id_b"]) for r in overlap.contained_pairs(df, block=block, union=True).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    # strips in which all records are too short or too long are left out
    monkeypatch.setattr(overlap, "STRIP", 8)
    kept = [np.unique(np.array([zlib.crc32(w.encode()) for w in ws], np.int64)) for ws in said]
    flat, lens = np.concatenate(kept), np.array([len(w) for w in kept], np.int64)
    packed = overlap._packed(np.arange(len(lens)), np.zeros(len(lens)), lens, flat, np.unique(flat)[:150])
    column, width = overlap._columns(packed, overlap.SHARE, True)
    dense = overlap._dense(packed, np.arange(len(lens)), column, width)
    common = np.array([[len(set(said[a]) & set(said[b])) for b in packed.ids] for a in packed.ids])
    assert width < 512 and (dense @ dense.T > common - 0.01).all()
    alike = {(int(x), int(y)) for i, j in overlap._alike(packed, packed, column, width, overlap.SHARE, True, lambda i, j: i != j) for x, y in zip(packed.ids[i], packed.ids[j])}
    assert alike == {(a, b) for a, x in enumerate(said) for b, y in enumerate(said) if a != b and 10 * len(set(x) & set(y)) >= 7 * len(set(x) | set(y))}


def test_contained_columns():
    """Few columns where a few hundred words recur in several languages, and sums that are never below the common words."""
    rng = np.random.default_rng(3)
    tongues = [rng.integers(-(2**62), 2**62, 400) for _ in range(3)]
    records = [np.unique(rng.choice(tongues[i % 3], rng.integers(30, 80))) for i in range(900)]
    flat = np.concatenate(records)
    own = np.sort(np.unique(flat)[: overlap.OWN])
    block = overlap._packed(np.arange(900), np.array(["val"] * 900, object), np.array([len(r) for r in records]), flat, own)
    column, width = overlap._columns(block, overlap.SHARE)
    assert width < 1024
    dense = overlap._dense(block, np.arange(900), column, width)
    sums = (dense @ dense.T).astype(int)
    for i, j in rng.integers(0, 900, (300, 2)):
        assert sums[i, j] >= len(np.intersect1d(records[block.ids[i]], records[block.ids[j]]))


def test_contained_counts(spark):
    from chatframe.llm.queries import QUERIES

    assert "p7_counts" in QUERIES
    rng = random.Random(12)
    text = lambda ws: f"<|im_start|>user\n{' '.join(ws)}\n[m]\n<|im_end|>\n<|im_start|>assistant\nok<|im_end|>"
    rows = [(i, rng.choice(["train", "train", "val", "test"]), rng.choice(["f", "g", None]), text(rng.sample([f"w{k}" for k in range(60)], 35 if i % 2 else 22))) for i in range(60)]
    rows += [(100, "train", "f", text([f"x{k}" for k in range(30)])), (101, "val", "g", text([f"x{29 - k}" for k in range(30)]))]
    df = spark.createDataFrame(rows + rows[:5], "sample_id bigint, split string, source_file string, text string").distinct()
    of, want = {i: (s, f) for i, s, f, _ in rows}, defaultdict(list)
    for a, b in brute([(i, s, t) for i, s, _, t in rows]):
        for x, y in ((a, b), (b, a)):
            want[(of[x][0], of[y][0], of[x][1])].append(x)
    got = {(r["split"], r["other"], r["source_file"]): (r["n_records"], r["n_pairs"]) for r in overlap.contained_counts(df, overlap.contained_pairs(df)).collect()}
    assert got == {k: (len(set(v)), len(v)) for k, v in want.items()} and ("val", "train", "g") in got and len(got) > 6
    assert overlap.contained_counts(df.limit(0), overlap.contained_pairs(df.limit(0))).count() == 0
    # the reordered record is no chunk's copy, so the shares by chunks alone miss it
    assert all(r["overlap"] < 0.5 for r in overlap.chunk_overlap(df, ("train", "val", "test")).where("sample_id = 101 and other = 'train'").collect())


def test_chunk_overlap(spark):
    rng = random.Random(9)
    text = lambda ws: f"<|im_start|>user\n{' '.join(ws)}\n[m]\n<|im_end|>\n<|im_start|>assistant\nok<|im_end|>"
    a = [f"a{rng.randint(0, 10**6)}" for _ in range(80)]
    b = [f"b{rng.randint(0, 10**6)}" for _ in range(80)]
    df = spark.createDataFrame([(1, "train", "f", text(a)), (2, "test", "f", text(a)), (3, "test", "f", text(a[:60] + b[:20])), (4, "val", None, text(b[40:])), (5, "val", None, None)], "sample_id bigint, split string, source_file string, text string")
    got = {(r["sample_id"], r["other"]): r["overlap"] for r in overlap.chunk_overlap(df, ("train", "val", "test")).collect()}
    assert got[(2, "train")] == 1.0 and 0.5 < got[(3, "train")] < 0.9 and got[(4, "train")] < 0.2 and not any(k[0] == 5 for k in got)
    assert overlap.chunk_overlap(df.limit(0), ("train", "val", "test")).count() == 0


SAYINGS = {
    "en": ["the queue at the bridge was slow today", "have you tried the new soup", "they said it will be ready tonight", "what happened with the old lamp"],
    "de": ["die Schlange bei der Brücke war heute lang", "hast du die neue Suppe probiert", "sie meinten es wird heute Abend fertig", "was ist mit der alten Lampe passiert"],
    "fr": ["la queue du pont était longue hier", "tu as déjà goûté la nouvelle soupe", "ils disent que ce sera prêt ce soir", "qu'est-ce qui s'est passé avec la vieille lampe"],
    "es": ["la cola del puente fue larga ayer", "ya has probado la nueva sopa", "dicen que estará lista esta noche", "qué pasó con la lámpara vieja"],
    "pt": ["a fila da ponte estava enorme ontem", "você já provou a sopa nova", "disseram que vai ficar pronto hoje à noite", "o que aconteceu com a lâmpada velha"],
    "hi": ["आज पुल पर बहुत भीड़ थी", "तुमने नया सूप देखा क्या", "उसने कहा था शाम को मिलेगा", "पुराने लैंप का क्या हुआ बताओ"],
    "hi-latn": ["aaj pul pe bahut bheed thi", "tune naya soup dekha kya", "usne bola tha shaam ko milega", "purane lamp ka kya hua bata na"],
}


def test_languages(spark):
    rng = random.Random(10)
    labels = {"en": ["en", "EN", "en_US", "English"], "hi-latn": ["hinglish", "hi_Latn"], "hi": ["hi-IN", "Hindi"], "pt": ["pt-BR"], "de": ["deu"], "fr": ["français"], "es": ["es-MX"]}
    docs = []
    for i in range(700):
        la = rng.choice(list(SAYINGS))
        lines = [rng.choice(SAYINGS[la]) for _ in range(6)]
        label = rng.choice(labels[la]) if rng.random() > 0.1 else rng.choice(["en", "de", None, "und"])
        docs.append((i, "\n".join(lines), label))
    special = {
        1000: ("Nilora: the queue at the bridge was slow today. hast du die neue Suppe probiert\nimage omitted", "en"), 1001: ("01/02/2024, 10:00 - Élodie: have you tried the new soup", "en-GB"), 1002: ("https://a.example/x 123 !!! 👍", "xx"),
        1003: ("", None), 1004: (None, "en"), 1005: ("aaj pul pe bahut bheed thi", "hi"), 1006: ("the queue at the bridge was slow today " * 3000, "English"), 1007: ("आज पुल पर बहुत भीड़ थी", "hi,en"),
        1008: ("have you\nneue Suppe", "fr"), 1009: ("hahahahaha aaaaaaa", "en"), 1010: ("26/12/2023,  08:31  -  Nilora  Almundar:  <Media  omitted>", "en"), 1011: ("[have you tried the new soup]", "en"),
    }
    docs += [(k, *v) for k, v in special.items()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    found = languages.identify(df, languages.fit(df)).cache()
    by = {r["doc_id"]: r for r in found.collect()}
    main = by[1000]["main_lang"]
    both = {"de": "hast du die neue Suppe probiert", "en": "the queue at the bridge was slow today"}
    assert by[1000]["langs"] == ["de", "en"] and [(s["lang"], special[1000][0][s["start"] : s["end"]]) for s in by[1000]["segments"]] == [(la, t) for la, t in both.items() if la != main]
    assert by[1001]["langs"] == ["en"] and all(by[i]["langs"] == [] for i in (1002, 1003, 1004)) and by[1006]["langs"] == ["en"] and by[1006]["confidence"] > 0.5
    cases = {(r["doc_id"], r["lang"]) for r in languages.mislabelled(found).where("doc_id >= 1000").collect()}
    assert cases == {(1000, "de"), (1000, "en"), (1005, "hi-latn"), (1008, "de"), (1008, "en")}
    assert by[1009]["langs"] == by[1010]["langs"] == [] and by[1011]["langs"] == ["en"]
    assert all(by[i]["main_lang"] == la for i, t, _ in docs[:700] for la in [next(k for k, v in SAYINGS.items() if t.split("\n")[0] in v)])
    assert languages.identify(df.limit(0), languages.Profiles()).count() == 0 and languages.mislabelled(languages.identify(df, languages.fit(df.limit(0)))).count() == 0


def test_share_of_hashes():
    assert languages.below(1.0) == 2**63 - 1 and languages.below(0.5) == 0
    few = languages.below(languages.MOST_DOCS / 22_000_000_000) + 2**63
    assert 0 < few < 2**64 * 1e-6


def test_language_names():
    assert languages.named("pt-BR") == {"pt"} and languages.named("en,hi-latn") == {"en", "hi-latn"} and languages.named("hi_Latn") == {"hi-latn"} and languages.named("mul") == languages.named(None) == set() and languages.named("français") == {"fr"}
