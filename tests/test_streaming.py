import datetime as dt
import os

from quaystone.operators import history as H
from quaystone.streaming.feeds import run_scd2_feed, run_ticket_feed

SCHEMA = "ticket_id bigint, status string, update_dt timestamp_ntz, create_month_label string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ticket_feed_late_data_and_replay(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "table")
    t = dt.datetime
    drops = [
        [(1, "open", t(2026, 6, 1, 9), "2026-06"), (2, "open", t(2026, 6, 2, 9), "2026-06")],
        [(1, "closed", t(2026, 6, 3, 9), "2026-06")],
        [(2, "stale", t(2026, 6, 1, 9), "2026-06"), (3, "new", t(2026, 7, 1, 9), "2026-07")],
    ]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").json(os.path.join(src, f"drop={i}"))
    run_ticket_feed(spark, os.path.join(src, "*"), SCHEMA, table, max_files_per_trigger=1,
                    stream_checkpoint=str(tmp_path / "ck1"))
    first = _rows(spark.read.parquet(table).select("ticket_id", "status"))
    assert first == [(1, "closed"), (2, "open"), (3, "new")]
    # replay every file with a fresh stream checkpoint: the table does not change
    run_ticket_feed(spark, os.path.join(src, "*"), SCHEMA, table, stream_checkpoint=str(tmp_path / "ck2"))
    assert _rows(spark.read.parquet(table).select("ticket_id", "status")) == first


def test_scd2_feed_replay_adds_no_versions(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "hist")
    schema = "batch_no int, sync_batch_id string, batch_time timestamp_ntz, id string, phone string, row_hash string"
    rows = [(1, "B1", dt.datetime(2026, 1, 1), "a", "1"), (1, "B1", dt.datetime(2026, 1, 1), "b", "2"),
            (2, "B2", dt.datetime(2026, 2, 1), "a", "9"), (2, "B2", dt.datetime(2026, 2, 1), "b", "2")]
    df = spark.createDataFrame([r + ("",) for r in rows], schema)
    df = df.withColumn("row_hash", H.row_hash(["id", "phone"]))
    for no in (1, 2):
        df.where(f"batch_no = {no}").write.mode("overwrite").json(os.path.join(src, f"batch={no}"))
    run_scd2_feed(spark, os.path.join(src, "*"), schema, table, "id", stream_checkpoint=str(tmp_path / "ck1"))
    hist = _rows(spark.read.parquet(table).select("id", "version_no", "is_current", "sync_batch_id"))
    assert hist == [("a", 1, False, "B1"), ("a", 2, True, "B2"), ("b", 1, True, "B1")]
    run_scd2_feed(spark, os.path.join(src, "*"), schema, table, "id", stream_checkpoint=str(tmp_path / "ck2"))
    assert _rows(spark.read.parquet(table).select("id", "version_no", "is_current", "sync_batch_id")) == hist


def test_ticket_feed_reports_what_came_too_late(spark, tmp_path):
    """Versions within the delay are merged once however often they come; older ones are reported, repeats aren't."""
    src, table, late = (str(tmp_path / n) for n in ("in", "table", "late"))
    day = lambda n: dt.datetime(2026, 6, 1) + dt.timedelta(days=n)
    drops = [[(1, "open", day(0), "2026-06"), (2, "open", day(20), "2026-06"), (9, "untimed", None, None)],
             [(1, "open", day(0), "2026-06"), (2, "open", day(20), "2026-06"), (2, "done", day(21), "2026-06"), (3, "new", day(19), "2026-06")],
             [(4, "lost", day(1), "2026-06"), (1, "lost", day(2), "2026-06"), (5, "kept", day(18), "2026-06"), (9, "untimed", None, None)]]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").json(os.path.join(src, f"drop={i}"))
        run_ticket_feed(spark, os.path.join(src, "*"), SCHEMA, table, stream_checkpoint=str(tmp_path / "seen"), delay="10 days",
                        late_path=late)
    assert _rows(spark.read.parquet(table).select("ticket_id", "status")) == [
        (1, "open"), (2, "done"), (3, "new"), (5, "kept"), (9, "untimed")]
    assert _rows(spark.read.parquet(late).select("ticket_id", "status")) == [(1, "lost"), (4, "lost")]
