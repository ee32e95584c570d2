"""Inputs that once lost rows or stopped a job: split batches, missing times and months, far dates, repeated keys."""

import datetime as dt
import os
import json

import pytest

from quaystone.functions import numbers
from quaystone.operators import allocation, contracts, history, sampling, tickets
from quaystone.session import checkpoint_dir
from quaystone.sources import envelope
from quaystone.sources.sinks import raw_archive
from quaystone.streaming import feeds


def write_json(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_ticket_feed_keeps_rows_without_time_or_month(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    schema = "ticket_id long, update_dt string, create_month_label string, v string"
    first = [{"ticket_id": 1, "v": "a"}, {"ticket_id": 2, "v": "b"},
             {"ticket_id": 3, "update_dt": "2024-01-02", "create_month_label": "2024-01", "v": "c"}]
    write_json(src, "a.json", first)
    feeds.run_ticket_feed(spark, str(src), schema, table, max_files_per_trigger=1, stream_checkpoint=str(tmp_path / "c"))
    write_json(src, "b.json", [{"ticket_id": 4, "v": "d"}, {"ticket_id": 1, "update_dt": "2024-01-01", "v": "a2"}])
    feeds.run_ticket_feed(spark, str(src), schema, table, max_files_per_trigger=1, stream_checkpoint=str(tmp_path / "c"))
    got = {r.ticket_id: r.v for r in spark.read.parquet(table).collect()}
    assert got == {1: "a2", 2: "b", 3: "c", 4: "d"}


SCD = "k string, v string, row_hash string, batch_no long, sync_batch_id string, batch_time timestamp_ntz"


def scd_row(k, v, n):
    return {"k": k, "v": v, "row_hash": v, "batch_no": n, "sync_batch_id": f"b{n}", "batch_time": f"2024-01-0{n}T00:00:00"}


def test_scd2_feed_applies_a_batch_spread_over_files(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    run = lambda c: feeds.run_scd2_feed(spark, str(src), SCD, table, "k", max_files_per_trigger=1,
                                        stream_checkpoint=str(tmp_path / c))
    write_json(src, "a.json", [scd_row("x", "1", 1)])
    write_json(src, "b.json", [scd_row("y", "1", 1)])
    write_json(src, "c.json", [scd_row("x", "2", 2)])
    run("c1")
    versions = lambda: sorted((r.k, r.v, r.is_current) for r in spark.read.parquet(table).collect())
    want = [("x", "1", False), ("x", "2", True), ("y", "1", True)]
    assert versions() == want
    run("c2")  # all files again, the stream's own state lost
    assert versions() == want


def test_history_step_without_end_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{path}/state=open/apply=1")
    spark.range(9).write.parquet(f"{path}/state=open/apply=2")  # stopped before its end
    os.remove(f"{path}/state=open/apply=2/_SUCCESS")
    spark.range(5).write.parquet(f"{path}/state=closed/apply=2")
    last, opened = feeds.read_open_versions(spark, path)
    assert last == 1 and opened.count() == feeds.read_history(spark, path).count() == 3


def test_open_ended_dates_and_large_numbers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(9999, 12, 31), 100.0, 2913000)],
                               "s date, e date, a double, d int")
    got = df.select(allocation.period_allocation("s", "e", "a", "d", dt.date(2024, 1, 1), dt.date(9999, 12, 31))).first()[0]
    assert got is not None and float(got) > 0
    texts = spark.createDataFrame([("9999999999",), ("1e20",), ("-7.9",), ("12",), ("x",)], "t string")
    assert [r[0] for r in texts.select(numbers.parse_int_text("t")).collect()] == [None, None, -7, 12, None]


def test_repeated_keys_do_not_multiply(spark):
    rows = spark.createDataFrame([("1",), ("2",), (None,)], "cid string")
    dim = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "id string, name string")
    assert tickets.enrich_name(rows, "cid", dim, "id", "name", "n").count() == 3
    lines = spark.createDataFrame([("k1", "P", "20240101"), ("k2", "P", "20240101")],
                                  "key string, sales_platform string, create_date string")
    base = spark.createDataFrame([("k1", "A", 1), ("k1", "B", 2)], "key string, sales_platform string, n int")
    got = {r.key: r.sales_platform for r in contracts.apply_baseline_platform(lines, base, ["key"], baseline_order="n").collect()}
    assert got == {"k1": "B", "k2": "P"}


def test_changed_counts_as_success(spark):
    df = spark.createDataFrame([("changed",), ("changed",), ("failed",)], "outcome string")
    r = history.outcome_counts(df).first()
    assert (r.updated, r.failed, r.status) == (2, 1, "partial")


def test_newest_row_without_times(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "2024", "b"), (2, None, "c")], "id int, t string, v string")
    assert {r.id: r.v for r in sampling.newest_per_id(df, "id", "t").collect()} == {1: "a", 2: "b"}


def test_nested_envelope_and_total(spark):
    df = spark.createDataFrame([('{"data": {"total": 7, "data": [{"k": 1}, {"k": 2}]}}',)], "body string")
    doc = envelope.parse_body(df, "body")
    assert envelope.unwrap_items(doc).count() == 2
    assert doc.select(envelope.declared_count()).first()[0] == 7


def test_checkpoint_folder_must_be_shared(spark, monkeypatch):
    class Context:
        master = "spark://host"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d: None)})
        sparkContext = Context

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session)


def test_option_tree_of_twelve_levels(spark):
    kind = "struct<key:string,value:string>"
    for _ in range(11):
        kind = f"struct<key:string,value:string,children:array<{kind}>>"
    node = None
    for k in range(12, 0, -1):
        node = (str(k), f"v{k}") if node is None else (str(k), f"v{k}", [node])
    df = spark.createDataFrame([("f", [node])], f"field string, options array<{kind}>")
    assert sorted(int(r.option_key) for r in tickets.flatten_option_tree(df, "field", "options").collect()) == list(range(1, 13))


def test_option_trees_under_all_child_names(spark):
    schema = ("f string, o array<struct<key:string,value:string,name:string,label:string,"
              "childs:array<struct<key:string,label:string,items:array<struct<key:string,name:string>>>>,"
              "options:array<struct<key:string,value:string>>>>")
    tree = spark.createDataFrame([("f", [
        ("1", "", "一", None, [("2", "二", [("3", "三")])], [("1", "later")]),
        (None, "no key", None, None, [("4", "四", None)], None),
        ("5", None, None, "五", None, None)])], schema)
    flat = tickets.flatten_option_tree(tree, "f", "o")
    got = {r.option_key: r.option_value for r in tickets.last_option_wins(flat, ["f"]).collect()}
    assert got == {"1": "later", "2": "二", "3": "三", "4": "四", "5": "五"}


def test_scans_reach_the_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, timestamp_ntz'1997-12-31 23:00:00' + make_interval(0, id, 0, 0, 0, 0, 0) AS at FROM range(24)") \
        .write.parquet(path)
    rows = spark.read.parquet(path)
    month = sampling.month_scan(rows, "at", "id", "1998-12", limit=1)
    assert [r.id for r in month.collect()] == [12]
    year = rows.where(sampling.in_year("at", 1998))
    assert year.count() == 12
    for df in (month, year, sampling.rows_of_id(rows, "id", 3, "at")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: []" not in plan and "PushedFilters" in plan
    assert sampling.rows_of_id(rows, "id", 3, "at").first().id == 3


def test_keep_last_reads_its_input_once(spark):
    df = spark.range(10).selectExpr("CAST(id % 3 AS string) AS k", "id", "IF(id > 7, '', 'x') AS part")
    out = contracts.dedup_keep_last(df, ["k", "part"], "id")
    assert out._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert sorted(r.id for r in out.collect()) == [5, 6, 7, 8, 9]


def test_ticket_key_holds_the_create_time(spark):
    main = spark.createDataFrame([(1, dt.datetime(2026, 1, 1), "a"), (1, None, "b"), (2, None, "c")],
                                 "ticket_id long, create_dt timestamp_ntz, v string")
    new = spark.createDataFrame([(1, dt.datetime(2026, 1, 2), "n"), (2, None, "m")], main.schema)
    out, _ = history.ticket_upsert(main, main, new, new, ["ticket_id", "create_dt"])
    assert sorted(r.v for r in out.collect()) == ["a", "b", "m", "n"]
    stored = main.withColumnRenamed("create_dt", "source_updated_at")
    marked = history.incremental_filter(new, stored, "ticket_id", "create_dt", known="known").collect()
    assert sorted((r.ticket_id, r.action, r.known) for r in marked) == [(1, "load", True), (2, "load", True)]


def test_the_partition_without_a_label_is_touched_too(spark):
    from quaystone.plans.jobs import touched_partitions
    stored = spark.createDataFrame([(1, "2026-01"), (2, None), (3, "2026-02")], "id int, m string")
    batch = spark.createDataFrame([("2026-01",), (None,)], "m string")
    assert sorted(r.id for r in touched_partitions(stored, batch, "m").collect()) == [1, 2]
    assert [r.id for r in touched_partitions(stored, batch.where("m IS NOT NULL"), "m").collect()] == [1]


def test_main_rows(spark):
    df = spark.createDataFrame([("7", "s", "2026-01-02 03:04:05", [("f", "u")])],
                               "ticketId string, subject string, updateDT string,"
                               " descriptattachments array<struct<name:string,url:string>>")
    wide, narrow = tickets.wide_main_row(df), tickets.narrow_main_row(df)
    assert len(wide.columns) == 61 and len(narrow.columns) == 34
    w, n = wide.first(), narrow.first()
    assert w.source_updated_at == n.update_dt == dt.datetime(2026, 1, 2, 3, 4, 5)
    assert w.descript_attachments == '[{"name":"f","url":"u"}]' and w.ticket_category == "原单" and n.ticket_id == 7


def test_archive_keeps_records_without_an_id(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), (None, "d"), (" ", "e")], "id string, v string")
    assert raw_archive(df, "B", "customer", "api", "id").count() == 4


def test_one_sheet_must_match():
    from quaystone.sources.layout import matching_sheet
    layouts = (["a", "b"], ["a", "b", "c"])
    assert matching_sheet({"notes": ["x"], "data": ["b", " a ", None]}, layouts) == "data"
    for sheets in ({"x": ["a"]}, {"x": ["a", "b"], "y": ["c", "b", "a"]}, {"x": ["a", "b", "a"]}):
        with pytest.raises(ValueError):
            matching_sheet(sheets, layouts)


def test_history_is_read_once(spark):
    schema = "id string, row_hash string"
    first = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], schema)
    hist, _ = history.scd2_apply(history.empty_history(first), first, "id", "B1", dt.datetime(2026, 1, 1))
    kept = hist.checkpoint()
    batch = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], schema)
    out, outcomes = history.scd2_apply(kept, batch, "id", "B2", dt.datetime(2026, 1, 2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "Join" not in plan
    assert sorted((r.id, r.version_no, r.is_current) for r in out.collect()) == [
        ("a", 1, True), ("b", 1, False), ("b", 2, True), ("c", 1, True), ("d", 1, True)]
    assert {r.id: r.outcome for r in outcomes.collect()} == {"a": "unchanged", "b": "changed", "d": "inserted"}
