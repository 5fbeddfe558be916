"""Kept, repeated and late rows of a stream, for any split of its files."""

import random
from collections import Counter
from datetime import datetime, timedelta
from hashlib import md5
from shutil import copytree

import pytest
from pyspark.sql import functions as F

from storeops.session import work_path
from storeops.streaming import late, loads

SCHEMA = "event_id long, ts timestamp, kind string, value double"
START = datetime(2024, 1, 1)


def _feed(spark, deliveries, per_batch=None):
    """Runs the stream once per delivery; returns its folder."""
    folder, landing, progress = (work_path(spark, n) for n in ("split", "landing", "progress"))
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)
        late.split_rows(loads.file_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, per_batch), folder, "event_id", "ts", "2 hours", progress)
    return folder


def _brute(deliveries, delay=timedelta(hours=2)):
    mark, kept, out = None, {}, []
    for rows in deliveries:
        reach = None if mark is None else mark - delay
        fresh = {}
        for i, (key, ts, _, _) in sorted(enumerate(rows), key=lambda x: (x[1][1] or START, x[0])):
            if ts is None or (reach is not None and ts < reach):
                out.append((key, "late"))
            elif key is not None and (key in fresh or (reach is not None and any(t >= reach for t in kept.get(key, [])))):
                out.append((key, "repeat"))
            else:
                out.append((key, "kept"))
                fresh.setdefault(key, []).append(ts)
        for key, times in fresh.items():
            kept.setdefault(key, []).extend(times)
        mark = max([t for _, t, _, _ in rows if t] + [mark] * bool(mark))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_has_one_outcome_for_any_split(spark, seed):
    rng = random.Random(seed)
    rows = [(i, START + timedelta(minutes=10 * i), "a", 1.0) for i in range(120)]
    rows += [rng.choice(rows) for _ in range(40)] + [(7, START + timedelta(hours=1), "a", 1.0)] * 30  # one key over and over
    rng.shuffle(rows)
    rows += [(None, START, "a", 1.0), (None, START + timedelta(hours=30), "a", 1.0), (500, None, "a", 1.0)]
    cuts = sorted(rng.sample(range(1, len(rows)), 3))
    deliveries = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    folder = _feed(spark, deliveries)
    got = Counter((r.event_id, r.outcome) for r in late.outcomes(spark, folder).collect())
    assert got == _brute(deliveries) and sum(got.values()) == len(rows)


def test_corrected_totals_are_those_of_all_rows_once(spark):
    rng = random.Random(3)
    rows = [(i, START + timedelta(minutes=37 * i), "ab"[i % 2], float(i)) for i in range(200)]
    rng.shuffle(rows)
    deliveries = [rows[:80], rows[60:150], rows[100:] + rows[:30]]
    folder = _feed(spark, deliveries)
    got = {(str(r.day), r.kind): (r.events, r.total) for r in late.corrected_totals(spark, folder, "event_id", "ts", "kind", "value", "2 hours").collect()}
    end = max(t for _, t, _, _ in rows) - timedelta(hours=2)
    want = {}
    for _, ts, kind, value in rows:
        if ts.date() < end.date():
            n, s = want.get((str(ts.date()), kind), (0, 0.0))
            want[(str(ts.date()), kind)] = (n + 1, s + value)
    assert got == want
    parts = late.corrected_totals(spark, folder, "event_id", "ts", "kind", "value", "2 hours").agg(F.sum("given_events"), F.sum("late_events"), F.sum("events")).first()
    assert parts[0] + parts[1] == parts[2] and parts[1] > 0


def test_a_batch_that_is_repeated_overwrites_itself(spark, monkeypatch):
    """The batch runs again from a checkpoint in which it never finished."""
    monkeypatch.setattr(late, "md5", lambda text: md5(b"one stream"))
    rows = [(i % 40, START + timedelta(minutes=i % 40), "a", 1.0) for i in range(50)]
    folder, landing, progress, again = (work_path(spark, n) for n in ("split", "landing", "progress", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame(rows, SCHEMA).write.parquet(landing)
    late.split_rows(loads.file_stream(spark, landing, schema), folder, "event_id", "ts", "2 hours", progress)
    copytree(progress, again, ignore=lambda at, names: [n for n in names if at.endswith("commits")])
    late.split_rows(loads.file_stream(spark, landing, schema), folder, "event_id", "ts", "2 hours", again)
    assert Counter(r.outcome for r in late.outcomes(spark, folder).collect()) == {"kept": 40, "repeat": 10}


def test_two_streams_share_mark_and_keys(spark):
    folder = work_path(spark, "split")
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in ([(1, START + timedelta(hours=9), "a", 1.0)], [(1, START + timedelta(hours=9), "a", 1.0), (2, START, "a", 1.0)]):
        landing = work_path(spark, "landing")
        spark.createDataFrame(rows, SCHEMA).write.parquet(landing)
        late.split_rows(loads.file_stream(spark, landing, schema), folder, "event_id", "ts", "2 hours", work_path(spark, "progress"))
    assert Counter((r.event_id, r.outcome) for r in late.outcomes(spark, folder).collect()) == {(1, "kept"): 1, (1, "repeat"): 1, (2, "late"): 1}
