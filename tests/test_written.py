"""Disk of the jobs that write tables between their steps."""

import datetime as dt
import os
import time

import pytest

from quaystone import session
from quaystone.operators import contracts as C
from quaystone.plans import jobs as J
from quaystone.plans import q_jobs as Q
from quaystone.session import unwritten, written


@pytest.fixture
def folder(monkeypatch, tmp_path):
    """A checkpoint folder that no other run writes to."""
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(tmp_path))
    return str(tmp_path)


def _shuffles(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [path.split("/")[-1] for path in manager.getAllFiles().mkString("|").split("|")]
    return {name for name in names if name.startswith("shuffle_")}


def _left(spark, before):
    """Shuffles that are left after a while."""
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.1)
    return _shuffles(spark) - before


def _tables(folder):
    return sorted(name.split("-")[0] for name in os.listdir(folder))


def test_a_written_table_is_the_same_and_can_be_deleted(spark, folder):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, `a b` string, `v` void")
    table = written(df, "test")
    assert table.schema == df.schema and sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))
    assert _tables(folder) == ["test"]
    unwritten(table)
    assert not os.listdir(folder)


def test_merge_keeps_one_table_and_no_shuffle_of_its_steps(spark, folder):
    new = [(0, Q.NEW_HEADER)] + [(k, [str(k // 2), "ORG", "CUST", str(k % 2), "D", f"n{k}", "NATION_1", "20260101", "2026-12-31", "1,000.50",
                                      "2026-01-01", "1", "2", ""]) for k in range(1, 9)]
    old = [(0, Q.OLD_HEADER)] + [(k, [str(10 + k), "OLD", f"o{k}", "D", "x", "y", "z", "NATION_3", "1", "2", "3", "50%", "20260101",
                                      "20260630", "7", "1", "2", ""]) for k in range(1, 6)]
    cells = [spark.createDataFrame([(n, c) for n, c in rows], "row_no int, cells array<string>").selectExpr(
        "cast(row_no as decimal(38,0)) row_no", "cells") for rows in (new, old)]
    shuffles = _shuffles(spark)
    merged = J.merge_contract_sources(*cells, list(Q.MERGE_RULES), Q.MERGE_RULES, Q.MERGE_CONFIG, dt.datetime(2026, 7, 15), ["a_2026-7-15.xlsx"],
                                      C.map_table(spark, {}, "from", "to"), C.map_table(spark, Q.ENGINEERS, "p", "e"))
    assert not _left(spark, shuffles) and _tables(folder) == ["ranged"]
    rows = merged.orderBy("序号").collect()
    assert [r["序号"] for r in rows] == list(range(1, 14)) and [r["合同编号"] for r in rows[-5:]] == ["11", "12", "13", "14", "15"]
    assert rows[0]["产品金额"] == 1000.5 and rows[-1]["营销平台"] == "NATION_4"


def test_ingest_writes_its_batches_as_tables(spark, folder):
    day = "2026-01-05 10:00:00"
    fields = "custom_fields array<struct<key string, value string>>"
    come = spark.createDataFrame([("1", "a", "7", "", day, day, [("f", "1")]), ("2", "b", "8", "", day, day, []), ("x", "c", "7", "", day, day, [])],
                                 f"ticketId string, subject string, custUserId string, ticketTemplateId string, createDT string, updateDT string, {fields}")
    stored = spark.createDataFrame([(2, dt.datetime(2026, 1, 5, 10), dt.datetime(2026, 1, 5, 10), "old")],
                                   "ticket_id long, create_dt timestamp_ntz, source_updated_at timestamp_ntz, subject string")
    child = spark.createDataFrame([], "ticket_id long, create_dt timestamp_ntz, field_key string, field_value string")
    named = lambda i, n: spark.createDataFrame([], f"{i} string, {n} string")
    args = dict(contacts=spark.createDataFrame([("7", "Ann")], "cId string, realName string"), agents=named("sId", "name"),
                groups=named("gId", "name"), templates=named("tId", "name"), field_names=named("key", "name"),
                field_options=spark.createDataFrame([], "field_key string, option_key string, option_value string"),
                global_options=named("option_key", "option_value"))
    out = J.ingest_tickets(come, stored, child, args)
    assert _tables(folder) == ["marked", "resolved"]
    assert sorted(map(tuple, out["main"].select("ticket_id", "subject").collect())) == [(1, "a"), (2, "old")]
    assert [tuple(r) for r in out["child"].select("ticket_id", "field_key", "field_value").collect()] == [(1, "f", "1")]
    assert out["counts"].select("inserted", "skipped", "failed").first().asDict() == {"inserted": 1, "skipped": 1, "failed": 1}
