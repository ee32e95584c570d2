"""SCD2 by many batches in one pass, the append-only history table, keys with blanks, the as-of merge join."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from quaystone.operators import history as H
from quaystone.operators import views as V
from quaystone.streaming import feeds

SCHEMA = "batch_no int, sync_batch_id string, batch_time timestamp_ntz, id string, v string, row_hash string"


def _day(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=n)


def _rows(numbers, seed, keys=12):
    rng = random.Random(seed)
    out = []
    for no in numbers:
        for k in rng.sample(range(keys), rng.randint(1, keys)):
            v = rng.choice("ab")
            out.append((no, f"B{no}", _day(no), f"k{k}", v, v))
    return out


def _apply_plain(state, rows):
    """Batches one after the other on a dict key -> versions."""
    for no, batch, time, key, v, h in sorted(rows, key=lambda r: (r[2], r[0])):
        versions = state.setdefault(key, [])
        if versions and versions[-1][2] >= time:
            continue
        if versions and versions[-1][1] == h:
            continue
        if versions:
            versions[-1] = (*versions[-1][:3], time)
        versions.append((batch, h, time, None))
    return state


def _shown(state):
    return sorted((k, n + 1, batch, since, until, until is None) for k, versions in state.items()
                  for n, (batch, _, since, until) in enumerate(versions))


def _table(df):
    return sorted((r.id, r.version_no, r.sync_batch_id, r.effective_from, r.effective_to, r.is_current) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_batches_in_one_pass(spark, seed):
    rows = _rows(range(1, 9), seed)
    empty = H.empty_history(spark.createDataFrame(rows, SCHEMA).drop("batch_no", "sync_batch_id", "batch_time"))
    all_at_once, _ = H.scd2_apply_batches(empty, spark.createDataFrame(rows, SCHEMA), "id", "batch_no", "sync_batch_id", "batch_time")
    assert _table(all_at_once) == _shown(_apply_plain({}, rows))
    # in two steps, with rows that come again
    first = [r for r in rows if r[0] <= 5]
    half, _ = H.scd2_apply_batches(empty, spark.createDataFrame(first, SCHEMA), "id", "batch_no", "sync_batch_id", "batch_time")
    half = half.checkpoint()
    rest, outcomes = H.scd2_apply_batches(half.where("is_current"), spark.createDataFrame(rows, SCHEMA), "id", "batch_no",
                                          "sync_batch_id", "batch_time")
    state = _apply_plain(_apply_plain({}, first), rows)
    assert _table(half.where("not is_current").unionByName(rest)) == _shown(state)
    assert outcomes.count() == len(rows)


def test_plan_does_not_grow_with_batches(spark):
    plans = []
    for n in (1, 12):
        rows = spark.createDataFrame(_rows(range(1, n + 1), 1), SCHEMA)
        empty = H.empty_history(rows.drop("batch_no", "sync_batch_id", "batch_time"))
        out, _ = H.scd2_apply_batches(empty, rows, "id", "batch_no", "sync_batch_id", "batch_time")
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert plans[0].count("Window") == plans[1].count("Window") and plans[1].count("Exchange hash") == 1


def test_outcomes(spark):
    opened = spark.createDataFrame([("a", "x", "1", 3, "B1", _day(5), None, True)],
                                   "id string, v string, row_hash string, version_no int, sync_batch_id string, "
                                   "effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    closed = spark.createDataFrame([("c", 4, _day(2))], "id string, version_no int, effective_from timestamp_ntz")
    rows = [(1, "N1", _day(4), "a", "y", "2"), (2, "N2", _day(5), "a", "x", "1"), (3, "N3", _day(6), "a", "x", "1"),
            (4, "N4", _day(7), "a", "y", "2"), (5, "N5", _day(7), "a", "z", "3"), (3, "N3", _day(6), "b", "x", "1"), (3, "N3", _day(6), "c", "x", "1")]
    versions, outcomes = H.scd2_apply_batches(opened, spark.createDataFrame(rows, SCHEMA), "id", "batch_no", "sync_batch_id", "batch_time",
                                              closed=closed)
    assert {(r.id, r.batch_no): (r.outcome, r.replayed) for r in outcomes.collect()} == {
        ("a", 1): ("skipped", True), ("a", 2): ("unchanged", True), ("a", 3): ("unchanged", False), ("a", 4): ("changed", False),
        ("a", 5): ("skipped", True), ("b", 3): ("inserted", False), ("c", 3): ("inserted", False)}
    assert sorted((r.id, r.version_no, r.effective_to) for r in versions.collect()) == [
        ("a", 3, _day(7)), ("a", 4, None), ("b", 1, None), ("c", 5, None)]


def _write(spark, rows, src):
    for no in sorted({r[0] for r in rows}):
        spark.createDataFrame([r for r in rows if r[0] == no], SCHEMA).write.mode("overwrite").json(os.path.join(src, f"batch={no}"))


def test_feed_rewrites_open_versions_only(spark, tmp_path):
    src, table, seen = (str(tmp_path / n) for n in ("in", "table", "seen"))
    rows = _rows(range(1, 15), 9)
    _write(spark, [r for r in rows if r[0] <= 12], src)
    feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=seen)
    closed = {f: os.path.getmtime(os.path.join(d, f)) for d, _, files in os.walk(f"{table}/state=closed") for f in files}
    assert feeds.read_open_versions(spark, table)[0] == 1
    _write(spark, rows, src)
    feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=seen)
    assert feeds.read_open_versions(spark, table)[0] == 2
    assert _table(feeds.read_history(spark, table)) == _shown(_apply_plain({}, rows))
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, files in os.walk(f"{table}/state=closed/apply=1") for f in files}
    assert after == closed
    # a replay with a fresh stream checkpoint makes no step
    feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=str(tmp_path / "again"))
    assert feeds.read_open_versions(spark, table)[0] == 2


@pytest.mark.parametrize("stop_after", ["closed", "open"])
def test_feed_survives_a_stop_between_its_steps(spark, tmp_path, monkeypatch, stop_after):
    src, table, seen = (str(tmp_path / n) for n in ("in", "table", "seen"))
    rows = _rows(range(1, 7), 5)
    _write(spark, [r for r in rows if r[0] <= 3], src)
    feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=seen)
    before = _table(feeds.read_history(spark, table))
    _write(spark, rows, src)
    whole = feeds._write_step

    def stopped(spark, versions, path, step):
        versions.where(~F.col("is_current")).write.mode("overwrite").parquet(f"{path}/state=closed/apply={step}")
        if stop_after == "open":
            versions.where("is_current").write.mode("overwrite").parquet(f"{path}/state=open/apply={step}")
        raise RuntimeError("stopped here")

    monkeypatch.setattr(feeds, "_write_step", stopped)
    with pytest.raises(Exception, match="stopped here"):
        feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=seen)
    want = _shown(_apply_plain({}, rows))
    assert _table(feeds.read_history(spark, table)) == (before if stop_after == "closed" else want)
    monkeypatch.setattr(feeds, "_write_step", whole)
    feeds.run_scd2_feed(spark, os.path.join(src, "*"), SCHEMA, table, "id", stream_checkpoint=seen)
    assert _table(feeds.read_history(spark, table)) == want
    assert sorted(os.listdir(f"{table}/state=open")) == ["apply=2"]


def test_upsert_compares_trimmed_keys(spark):
    current = spark.createDataFrame([("A", "1", 1), ("", "1", 2), (None, "1", 3), ("B", "1", 4)], "k string, i string, v int")
    changes = spark.createDataFrame([("A ", "1", 10, 1), (" A", "1", 11, 2), ("", "1", 20, 3), ("", "1", 21, 4), (None, "1", 30, 5),
                                     ("C", " ", 40, 6)], "k string, i string, v int, o int")
    out = H.snapshot_upsert(current, changes, ["k", "i"], "o", ["v"])
    assert sorted(((r.k, r.i, r.v, r.outcome) for r in out.collect()), key=str) == sorted([
        ("A", "1", 11, "updated"), ("", "1", 2, "kept"), (None, "1", 3, "kept"), ("B", "1", 4, "kept"), ("", "1", 20, "inserted"),
        ("", "1", 21, "inserted"), (None, "1", 30, "inserted"), ("C", " ", 40, "inserted")], key=str)


# -- as-of merge join ---------------------------------------------------------------------

HISTORY = ("id string, name string, version_no int, effective_from timestamp_ntz, effective_to timestamp_ntz")
TICKETS = "company string, ticket_id bigint, ticket_status string, create_dt timestamp_ntz, solve_dt timestamp_ntz"


def _timeline(seed):
    rng = random.Random(seed)
    history, tickets = [], []
    for k in range(8):
        at = sorted(rng.sample(range(1, 60), rng.randint(1, 6)))
        for n, since in enumerate(at):
            until = at[n + 1] if n + 1 < len(at) else (None if rng.random() < 0.6 else since + 9)
            if until is not None and rng.random() < 0.2:
                until -= 1  # a gap
            history.append((f"k{k}", f"n{n}", n + 1, _day(since), None if until is None else _day(until)))
    for t in range(400):
        key = "k0" if t % 3 == 0 else rng.choice([f"k{k}" for k in range(9)] + [None])
        created = _day(rng.randint(0, 70))
        tickets.append((key, t if t % 17 else None, rng.choice(["4", "2", None]), None if t % 29 == 0 else created,
                        None if t % 5 else created + dt.timedelta(hours=t)))
    return history, tickets


def _overview_plain(history, tickets):
    out = []
    for key, name, n, since, until in history:
        inside = [t for t in tickets if t[0] == key and t[3] is not None and since <= t[3] and (until is None or t[3] < until)]
        solved = [(t[4] - t[3]).total_seconds() for t in inside if t[4] is not None]
        known = [t[2] == "4" for t in inside if t[2] is not None]
        out.append((key, n, name, sum(t[1] is not None for t in inside), sum(known) if known else None,
                    round(sum(solved) / len(solved), 6) if solved else None))
    return sorted(out)


@pytest.mark.parametrize("hot", [1_000_000, 40])
def test_as_of_join(spark, hot):
    """The same with a key that holds a third of the tickets cut by time."""
    history, tickets = _timeline(3)
    out = V.service_overview(spark.createDataFrame(history, HISTORY), spark.createDataFrame(tickets, TICKETS), "id", "company", ["name"],
                             resolved_values=("4",), hot=hot, pieces=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and (hot < 1000 or "Join" not in plan)
    got = [(r.id, r.version_no, r.name, r.ticket_count, r.resolved_ticket_count,
            None if r.avg_resolution_seconds is None else round(r.avg_resolution_seconds, 6)) for r in out.collect()]
    assert sorted(got) == _overview_plain(history, tickets)


def test_hot_key_is_cut(spark):
    _, tickets = _timeline(3)
    events = spark.createDataFrame(tickets, TICKETS).where("company is not null and create_dt is not null")
    cuts = V._time_cuts(events, "company", "create_dt", 100, 8).collect()
    assert [r.company for r in cuts] == ["k0"] and len(cuts[0]["__cuts"]) == 7
    assert V._time_cuts(events, "company", "create_dt", 1000, 8) is None


def test_name_join_of_hot_names(spark):
    rng = random.Random(2)
    left = [(k, rng.choice(["x"] * 6 + ["y", "z", None])) for k in range(300)]
    right = [(k, rng.choice(["x", "x", "y", "w", None])) for k in range(60)]
    a, b = spark.createDataFrame(left, "l int, ln string"), spark.createDataFrame(right, "r int, rn string")
    out = V.name_join(a, b, "ln", "rn", rows_per_task=500)
    want = sorted((l, n, r, m) for l, n in left for r, m in right if n is not None and n == m)
    assert sorted(map(tuple, out.collect())) == want
