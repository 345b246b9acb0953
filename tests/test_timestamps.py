"""Notations, zones and clock changes; Viterbi over a source."""

from datetime import UTC, datetime

import itertools
import random

import pytest

from chatframe.operators.timestamps import normalise_timestamps, viterbi

DEVICES = [(1, "Asia/Kolkata", True), (2, "America/New_York", False), (3, "Europe/Berlin", True), (4, "Australia/Sydney", True), (5, "Asia/Kolkata", None), (6, None, True)]
CASES = [
    ("16/12/2024, 18:49", 1, "2024-12-16 13:19:00"), ("[07/17/2024, 08:41:07]", 2, "2024-07-17 12:41:07"), ("17/07/2024, 08:41", 2, None),
    ("2022-10-19T12:06:14+05:30", 3, "2022-10-19 06:36:14"), ("2024-10-24T10:59:59.370Z", 1, "2024-10-24 10:59:59.37"), ("1721067086.401", 1, "2024-07-15 18:11:26.401"),
    ("1689795976", 2, "2023-07-19 19:46:16"), ("1694310357198", 2, "2023-09-10 01:45:57.198"), ("1694411751368726", 2, "2023-09-11 05:55:51.368726"), ("20220801T145728Z", 1, "2022-08-01 14:57:28"),
    ("Mon, 26 Sep 2022 16:45:26 +0100", 1, "2022-09-26 15:45:26"), ("19 Mar 2023 15:27:00 GMT", 2, "2023-03-19 15:27:00"), ("2022-07-12 20:13:36 CEST", 3, "2022-07-12 18:13:36"),
    ("2024-02-22 20:10:54 America/Los_Angeles", 1, "2024-02-23 04:10:54"), ("2023-10-23T07:23:05[Australia/Sydney]", 1, "2023-10-22 20:23:05"), ("15 July 2022 at 12:19 AM", 3, "2022-07-14 22:19:00"),
    ("Fri 22 Dec 2023, 10h37", 1, "2023-12-22 05:07:00"), ("3. März 2025, 20:13 Uhr", 3, "2025-03-03 19:13:00"), ("21/5/25, 11:41 pm", 1, "2025-05-21 18:11:00"), ("‎ ३/१२/२३, ३:२० am", 1, "2023-12-02 21:50:00"),
    ("12.06.2024 19:24", 2, "2024-06-12 23:24:00"), ("2024-03-06T04:55:45.1672394+0000", 1, "2024-03-06 04:55:45.167239"),
    ("2024-10-27 02:30:00", 3, "2024-10-27 00:30:00"), ("2024-10-27 02:30:00 CET", 3, "2024-10-27 01:30:00"), ("2024-10-27 02:30:00 Europe/Berlin", 3, "2024-10-27 00:30:00"),
    ("2024-03-31 02:30:00", 3, None), ("2024-10-06 02:10:00", 4, None), ("31/02/2024, 9:15", 1, None), ("24:61", 1, None), ("2024-13-45 25:61", 1, None), ("15/03/2024", 1, None), ("13:05 PM", 1, None),
    ("01/02/2024, 13:05 PM", 1, None), ("2024-01-01 10:00:60", 1, None), ("2024-01-01 10:00:00 Mars/Olympus", 1, None), ("yesterday", 1, None), ("", 1, None), (None, 1, None), ("x" * 100_000, 1, None),
    ("2024-01-01 10:00:00", 6, None), ("2024-01-01 10:00:00Z", 6, "2024-01-01 10:00:00"), ("2024-01-01 10:00:00", 99, None), ("2024-01-01 10:00:00Z", None, "2024-01-01 10:00:00"),
]


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame(DEVICES, "device_id int, zone string, day_first boolean")


def table(spark, rows):
    return spark.createDataFrame(rows, "msg_id bigint, source_file string, datetime string, device_id int, utc_us string, rec bigint")


def test_notations(spark, devices):
    rows = [(i, "s", v, d, "clash", -1) for i, (v, d, _) in enumerate(CASES)]
    got = {r["msg_id"]: r["utc_us"] for r in normalise_timestamps(table(spark, rows + rows[:5] + [(None, "s", "1689795976", 1, None, None)]), devices).collect()}
    for i, (v, d, want) in enumerate(CASES):
        us = None if want is None else round(datetime.fromisoformat(want).replace(tzinfo=UTC).timestamp() * 1e6)
        assert got.get(i) == us, (v, d)
    assert None not in got


def test_viterbi_decides_the_date_order_of_a_source(spark, devices):
    texts = ["01/13/2024, 10:00", "02/01/2024, 10:00", "02/03/2024, 10:00", "03/25/2024, 10:00"]  # month first, seen at both ends
    rows = [(i, "us", t, 5, None, None) for i, t in enumerate(texts)] + [(100 + i, "in", t, 5, None, None) for i, t in enumerate(["13/01/2024, 10:00", "02/02/2024, 10:00", "03/02/2024, 10:00"])]
    rows += [(200, None, "02/03/2024, 10:00", 5, None, None)]
    got = {r["msg_id"]: (r["kind"], r["utc_us"]) for r in normalise_timestamps(table(spark, rows), devices).collect()}
    assert [got[i][0] for i in range(4)] == ["mdy"] * 4 and got[102][0] == "dmy" and got[200][0] == "dmy"


def test_viterbi_against_all_paths(spark):
    rng, rows = random.Random(5), []
    for source in ("a", "b", "c"):
        for i in range(11):
            t = rng.randrange(20)
            both = [{"kind": "dmy", "utc_us": t}, {"kind": "mdy", "utc_us": rng.randrange(20)}]
            rows.append((source, (i + 1) ** 9 * 10 + ord(source), both if rng.random() < 0.7 else [rng.choice([both[0], both[1], {"kind": "iso", "utc_us": t}])]))  # sparse ids
    df = spark.createDataFrame(rows, "source string, rec bigint, readings array<struct<kind string, utc_us bigint>>")
    got = {(r["source"], r["rec"]): (r["kind"], r["utc_us"]) for r in viterbi(df, 4).collect()}

    def cost(path):
        own = sum(0.01 for r, k in path if k["kind"] == "mdy" and len(r) > 1)
        return own + sum((2.0 if b["utc_us"] < a["utc_us"] else 0) + (1.0 if {a["kind"], b["kind"]} == {"dmy", "mdy"} else 0) for (_, a), (_, b) in zip(path, path[1:]))

    for source in ("a", "b", "c"):
        mine = [(rec, r) for s, rec, r in rows if s == source]
        least = min(cost(list(zip([r for _, r in mine], pick))) for pick in itertools.product(*(r for _, r in mine)))
        chosen = [next(x for x in r if (x["kind"], x["utc_us"]) == got[source, rec]) if len(r) > 1 else r[0] for rec, r in mine]
        assert abs(cost(list(zip([r for _, r in mine], chosen))) - least) < 1e-9


def test_empty(spark, devices):
    assert normalise_timestamps(table(spark, []), devices).count() == 0
    assert normalise_timestamps(table(spark, [(1, "s", "1689795976", 1, None, None)]), devices.limit(0)).count() == 1
