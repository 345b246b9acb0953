"""Gap trees against a loop, and the hard cases of sessions."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatframe.operators.gap_tree import _OPEN, _chunk_nodes, _spans, cut_tree, gap_tree, sessions

SCHEMA = "source_file string, datetime timestamp_ntz, msg_id bigint"
T0 = datetime(2024, 1, 1)


def loop(rows, gap_s):
    by = {}
    for s, t, i in {(s, t, i) for s, t, i in rows if s is not None and t is not None}:
        by.setdefault(s, []).append((t, i))
    out = set()
    for s, ts in by.items():
        ts.sort()
        start = prev = ts[0][0]
        n = 0
        for t, _ in ts:
            if (t - prev).total_seconds() > gap_s:
                out.add((s, start, prev, n))
                start, n = t, 0
            prev, n = t, n + 1
        out.add((s, start, prev, n))
    us = lambda t: round((t - datetime(1970, 1, 1)).total_seconds() * 1e6)
    return {(s, us(a), us(b), n) for s, a, b, n in out}


def got(df):
    rows = [(r["entity"], r["start_us"], r["end_us"], r["n_events"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_every_threshold_from_one_tree(spark):
    rng = np.random.default_rng(3)
    rows, t = [], dict.fromkeys("abc", T0)
    for i in range(900):
        s = "a" if i % 3 else "bc"[i % 2]
        t[s] += timedelta(seconds=int(rng.choice([0, 5, 59, 60, 61, 600, 3600, 3601, 90_000])))
        rows.append((s, t[s], i))
    rng.shuffle(rows)
    rows = [(s, t, int(i)) for s, t, i in rows]
    df = spark.createDataFrame(rows + rows[:40] + [(None, T0, 1), ("a", None, 2)], SCHEMA)
    tree = gap_tree(df, "source_file", "datetime", "msg_id", chunk_s=86_400).cache()
    for gap in (60, 600, 3600, 86_400, 10**6):
        assert got(cut_tree(tree, gap)) == loop(rows, gap)
    assert got(sessions(df, "source_file", "datetime", "msg_id", threshold_s=3600, chunk_s=3600)) == loop(rows, 3600)
    # an inner node per gap between atoms, one root per entity
    assert tree.where("parent_gap_us is null").count() == 3


def test_border_of_the_gap_and_ties(spark):
    rows = [("x", T0, 1), ("x", T0 + timedelta(seconds=3600), 2), ("x", T0 + timedelta(seconds=7200, microseconds=1), 3), ("x", T0, 4)]
    assert {n for *_, n in got(sessions(spark.createDataFrame(rows, SCHEMA), "source_file", "datetime", "msg_id"))} == {3, 1}


def test_empty_nulls_and_extra_columns(spark):
    assert sessions(spark.createDataFrame([], SCHEMA), "source_file", "datetime", "msg_id").count() == 0
    assert sessions(spark.createDataFrame([(None, None, None)], SCHEMA), "source_file", "datetime", "msg_id").count() == 0
    odd = spark.createDataFrame([("x", T0, None, "e", 1), ("x", T0, None, "e", 1)], SCHEMA + ", entity string, slot int")
    assert got(sessions(odd, "source_file", "datetime", "msg_id")) == loop([("x", T0, None)], 3600)


def test_threshold_below_the_slot_is_refused(spark):
    with pytest.raises(ValueError):
        gap_tree(spark.createDataFrame([], SCHEMA), "source_file", "datetime", "msg_id", threshold_s=10)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), max_size=30))
def test_nodes_of_a_chunk(gaps):
    start = np.concatenate([[0], np.cumsum(gaps)]).astype(np.int64)
    n = np.ones(len(start), np.int64)
    closed, items = _chunk_nodes(np.zeros(len(start), int), start, start, n)
    assert items.n_events.sum() == len(start)
    assert (closed.gap_us < closed.parent_gap_us).all() or (closed.gap_us <= closed.parent_gap_us).all()
    left, right = _spans(np.array(gaps, np.int64))
    for i, g in enumerate(gaps):
        assert all(x <= g for x in gaps[left[i] + 1 : i]) and all(x < g or x == g for x in gaps[i + 1 : right[i]])
    assert (closed.parent_gap_us != _OPEN).all()
