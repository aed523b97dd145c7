"""Chunked ordered operators against a plain Python walk, with a hot key and ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millgauge.operators.downtime import batch_changes, downtime_fact
from millgauge.operators.sequence import count_starts, episodes, first_per, gap_starts, newest_per, number_gaps, ordered_columns, run_lengths

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def history(n=600, seed=7):
    """One key with most rows, quiet hours, equal times."""
    rng = random.Random(seed)
    out, t = [], {"hot": 0, "b": 0, "c": 50000}
    for i in range(n):
        k = "hot" if rng.random() < 0.8 else rng.choice(["b", "c"])
        t[k] += rng.choice([0, 1, 30, 900, 4000, 20000])
        out.append((k, START + dt.timedelta(seconds=t[k]), i, rng.choice([None, 1, 2, 3]), rng.random() < 0.4))
    return out


@pytest.fixture(scope="module")
def rows():
    return history()


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp, id long, v int, down boolean")


def walk(rows):
    for k in {r[0] for r in rows}:
        yield k, sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2]))


@pytest.mark.parametrize("chunk", [1, 3600, 86400 * 365])
def test_ordered_columns(df, rows, chunk):
    got = ordered_columns(
        df, ["k"], "ts", ["id"],
        lag={"before": F.col("v")}, lead={"after": F.col("v")}, last={"seen": F.col("v")},
        total={"acc": F.coalesce("v", F.lit(0))}, following={"coming": F.col("v")}, chunk_seconds=chunk,
    )
    have = {r.id: (r.before, r.after, r.seen, r.acc, r.coming) for r in got.collect()}
    want = {}
    for _, seq in walk(rows):
        acc, seen = 0, None
        for i, r in enumerate(seq):
            acc += r[3] or 0
            seen = r[3] if r[3] is not None else seen
            coming = next((x[3] for x in seq[i:] if x[3] is not None), None)
            want[r[2]] = (seq[i - 1][3] if i else None, seq[i + 1][3] if i + 1 < len(seq) else None, seen, acc, coming)
    assert have == want


def test_gap_starts(df, rows):
    have = {r.id for r in gap_starts(df, ["k"], "ts", ["id"], 900).collect()}
    want = set()
    for _, seq in walk(rows):
        for i, r in enumerate(seq):
            if i == 0 or (r[1] - seq[i - 1][1]).total_seconds() > 900:
                want.add(r[2])
    assert have == want


def expected_episodes(rows):
    out = set()
    for k, seq in walk(rows):
        start = None
        for r in seq:
            if r[4] and start is None:
                start = r[1]
            elif not r[4] and start is not None:
                out.add((k, start, r[1]))
                start = None
        if start is not None:
            out.add((k, start, None))
    return out


def test_episodes(df, rows):
    got = episodes(df, ["k"], "ts", ["id"], F.col("down")).select("k", "ts", "ended_at").collect()
    utc = lambda t: t and t.astimezone(dt.timezone.utc)
    assert {(r.k, utc(r.ts), utc(r.ended_at)) for r in got} == expected_episodes(rows)


def test_first_and_newest(df, rows):
    have = {r.k: r.id for r in first_per(df, ["k"], ["ts", "id"]).collect()}
    last = {r.k: r.id for r in newest_per(df, ["k"], ["ts", "id"]).collect()}
    assert have == {k: seq[0][2] for k, seq in walk(rows)}
    assert last == {k: seq[-1][2] for k, seq in walk(rows)}


def test_empty_input(df):
    none = df.where("false")
    assert episodes(none, ["k"], "ts", ["id"], F.col("down")).count() == 0
    assert ordered_columns(none, ["k"], "ts", lag={"p": F.col("v")}).count() == 0


def test_window_never_spans_a_whole_key(df):
    plan = ordered_columns(df, ["k"], "ts", ["id"], lag={"p": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2  # one inside chunks, one over the chunk summaries
    assert any("_chunk" in w.split("], [")[1] for w in windows)


def test_batch_changes_follow_batch_form(spark, star):
    """Readings cut into ten batches give the same stops as one pass."""
    from millgauge.operators.downtime import as_open, close_episodes, still_open

    rows = star.conformed.cache()
    whole = {(r.machine_id, r.started_at, r.ended_at) for r in downtime_fact(rows).collect()}
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    state = spark.createDataFrame([], "machine_id string, open_started_at timestamp")
    got = {}
    for part in [days[i::1][:3] for i in range(0, len(days), 3)]:
        opened, closed = batch_changes(rows.where(F.col("event_date").isin(part)), state)
        after = still_open(state, opened, closed).collect()
        for r in close_episodes(as_open(opened), closed).collect():
            got[(r.machine_id, r.started_at)] = r.ended_at
        for r in closed.collect():
            got[(r.machine_id, r.started_at)] = r.ended_at
        state = spark.createDataFrame(after, "machine_id string, open_started_at timestamp")
    rows.unpersist()
    assert {(m, s, e) for (m, s), e in got.items()} == whole


@pytest.mark.parametrize("seed,chunk", [(7, 3600), (8, 60), (9, 86400)])
def test_associative_scans(spark, seed, chunk):
    """Run numbers, gap episodes and run lengths against a walk; each reads its input twice."""
    rows = history(700, seed)
    df = spark.createDataFrame([(*r, r[1] + dt.timedelta(seconds=(r[3] or 0) * 2500)) for r in rows],
                               "k string, ts timestamp, id long, v int, down boolean, until timestamp")
    want = {}
    for k, seq in walk(rows):
        begun = run = episode = 0
        was, reach = False, None
        for _, t, i, v, down in seq:
            begun += down and not was
            run = run + 1 if down else 0
            episode += reach is None or (t - reach).total_seconds() > 700
            end = t + dt.timedelta(seconds=(v or 0) * 2500)
            reach = end if reach is None else max(reach, end)
            was = down
            want[i] = (begun, run, episode)
    by = (["k"], "ts", ["id"])
    got = count_starts(df, *by, F.col("down"), "a", chunk_seconds=chunk)
    got = run_lengths(got, *by, F.col("down"), "b", chunk_seconds=chunk)
    got = number_gaps(got, *by, F.col("until"), 700, "c", chunk_seconds=chunk)
    assert {r.id: (r.a, r.b, r.c) for r in got.collect()} == want
