"""Evolving schemas, quarantine with replay, partition and bucket look-ups, list and option decoding with repeated dimensions."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaystone.operators import labels as LB
from quaystone.operators import sampling as S
from quaystone.operators import tickets as TK
from quaystone.sources import envelope as EV
from quaystone.sources import layout as L
from quaystone.sources import partitions as P


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "double", "double"), ("int", "string", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(30,2)", "decimal(20,12)", "string"), ("void", "int", "int"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("array<int>", "array<double>", "array<double>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("array<int>", "int", "string"), ("boolean", "int", "string")])
def test_wider_type(spark, a, b, want):
    kind = lambda text: T._parse_datatype_string(f"x {text}").fields[0].dataType
    assert L.wider_type(kind(a), kind(b)) == L.wider_type(kind(b), kind(a)) == kind(want)


def test_read_versions(spark, tmp_path):
    paths = [str(tmp_path / f"v{k}") for k in range(3)]
    spark.sql("select 1 as id, 7 as v, named_struct('a', 1) as s, array(1, 2) as l").write.parquet(paths[0])
    spark.sql("select 2L as id, 7.25BD as v, named_struct('a', 2L, 'b', 'x') as s, cast(null as array<double>) as l").write.parquet(paths[1])
    spark.sql("select 'n' as v, date'2026-01-02' as d, cast(null as struct<a:int>) as s").write.parquet(paths[2])
    out = L.read_versions(spark, paths)
    assert [f"{n} {t}" for n, t in out.dtypes] == ["id bigint", "v string", "s struct<a:bigint,b:string>", "l array<double>", "d date"]
    assert sorted(map(tuple, out.select("id", "v", "s.a", "s.b", "l", "d").collect()), key=str) == sorted([
        (1, "7", 1, None, [1.0, 2.0], None), (2, "7.25", 2, "x", None, None), (None, "n", None, None, None, dt.date(2026, 1, 2))], key=str)
    plan = out.where("id = 2").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<id:") == 2 and "struct<a" not in plan


def test_widening_keeps_values(spark, tmp_path):
    paths = [str(tmp_path / f"v{k}") for k in range(2)]
    spark.sql("select 2147483647 as n").write.parquet(paths[0])
    spark.sql("select 0.125BD as n").write.parquet(paths[1])
    assert sorted(r.n for r in L.read_versions(spark, paths).collect()) == [Decimal("0.125"), Decimal("2147483647.000")]


def test_quarantine_and_replay(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = [(1, '[{"k": 1}]'), (2, '[{"k": 2}'), (3, ""), (4, None), (5, '{"k": 5}'), (6, '[{"k": 6}')]
    bodies = spark.createDataFrame(rows, "id int, body string")
    for _ in range(2):  # the same batch again
        good = EV.quarantine(bodies, path, "B1", ["id"])
    assert [r.id for r in good.collect()] == [1]
    held = spark.read.parquet(f"{path}/rejects")
    assert sorted((r.id, r.reason) for r in held.collect()) == [(2, "broken"), (3, "empty"), (4, "empty"), (5, "no_list"), (6, "broken")]
    mend = lambda c: F.concat(c, F.lit("]"))
    first = EV.replay(spark, path, "r1", ["id"], mend, "id int")
    assert sorted((r.id, r.batch) for r in EV.unwrap_items(first, "doc", ["id", "batch"]).collect()) == [(2, "B1"), (6, "B1")]
    assert EV.replay(spark, path, "r2", ["id"], mend, "id int").count() == 0
    assert sorted(r.id for r in EV.replay(spark, path, "r1", ["id"], mend, "id int").collect()) == [2, 6]


def test_newest_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = spark.createDataFrame([(1, "20260101"), (2, "20260713"), (3, "20260713"), (4, None)], "v int, create_date string")
    df.write.partitionBy("create_date").parquet(path)
    os.makedirs(f"{path}/_temporary")
    out = P.read_newest_partition(spark, path, "create_date", df.schema)
    assert sorted(r.v for r in out.collect()) == [2, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(create_date" in plan
    with pytest.raises(ValueError):
        P.read_newest_partition(spark, str(tmp_path), "create_date", df.schema)


def test_one_id_reads_one_bucket(spark, tmp_path):
    rows = [(k % 40, None if k % 3 else dt.datetime(2026, 1, 1 + k % 28), k) for k in range(400)]
    df = spark.createDataFrame(rows, "id bigint, at timestamp_ntz, v int")
    stored = P.save_by_id(df, "tickets_by_id_test", str(tmp_path / "t"), "id", 8)
    out = S.rows_of_id(stored, "id", 7, "at", ["v"])
    assert "SelectedBucketsCount: 1 out of 8" in out._jdf.queryExecution().executedPlan().toString()
    mine = [r for r in rows if r[0] == 7]
    best = max(mine, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[2]))
    assert [tuple(r) for r in out.collect()] == [best]
    none = spark.createDataFrame([(1, None, 1), (1, None, 2)], "id bigint, at timestamp_ntz, v int")
    assert S.rows_of_id(none, "id", 1, "at", ["v"]).first().v == 2
    spark.sql("drop table tickets_by_id_test")


def test_lists_with_repeated_ids_and_rows(spark):
    dim = spark.createDataFrame([("7", "y"), ("7", "x"), ("8", "z"), ("9", " ")], "id string, name string")
    df = spark.createDataFrame([(1, "7,8"), (1, "7,8"), (2, "8，7,5,9"), (3, ""), (4, None)], "t int, ids string")
    out = TK.enrich_id_list(df, "ids", dim, "id", "name", "names")
    assert sorted(((r.t, r.ids, r.names) for r in out.collect()), key=str) == sorted([
        (1, "7,8", "x,z"), (1, "7,8", "x,z"), (2, "8，7,5,9", "z,x,5,9"), (3, "", None), (4, None, None)], key=str)


def test_options_given_twice(spark):
    eav = spark.createDataFrame([(1, "f", "a"), (2, "f", "b"), (3, "g", "b")], "t int, field_key string, field_value string")
    fo = spark.createDataFrame([("f", "a", "two"), ("f", "a", "one"), ("f", "a", "")], "field_key string, option_key string, option_value string")
    go = spark.createDataFrame([("b", "B"), ("b", ""), ("b", "C")], "option_key string, option_value string")
    names = spark.createDataFrame([("f", "F"), ("f", " "), ("f", "E")], "key string, name string")
    out = TK.decode_field_values(eav, fo, go, names)
    assert sorted((r.t, r.field_name, r.decoded_value) for r in out.collect()) == [(1, "E", "one"), (2, "E", "B"), (3, "g", "B")]


def test_too_many_field_names(spark, monkeypatch):
    rows = [(1, [("所在地区", "420000 湖北省"), ("城市", "武汉市")]), (2, [("省份", ""), ("区县", "北京市"), ("市", "110100 北京市")]), (3, None)]
    df = spark.createDataFrame(rows, "id int, f array<struct<key:string,value:string>>")
    want = sorted(map(str, TK.extract_dimensions(df, "f").collect()))
    monkeypatch.setattr(TK, "MAX_FIELD_NAMES", 2)
    assert sorted(map(str, TK.extract_dimensions(df, "f").collect())) == want


@pytest.mark.parametrize("line,field,kind,comment,label", [
    ("ticket_id bigint(20) 工单ID", "ticket_id", "bigint(20)", "工单ID", "工单ID"),
    ("a int unsigned 用户", "a", "int unsigned", "用户", "用户"),
    ("a int unsignedly", "a", "int", "unsignedly", "unsignedly"),
    ("a varchar (16) 名（备注）", "a", "varchar (16)", "名(备注)", "名"),
    ("ticket_idbigint(20) 编号", "ticket_id", "bigint(20)", "编号", "编号"),
    ("status INT 状态 1=新;2=旧", "status", "INT", "状态 1=新;2=旧", "状态"),
    ("status int 状态 0 - 无", "status", "int", "状态 0 - 无", "状态"),
    ("made_at datetime", "made_at", "datetime", "", "made_at"),
    ("a text 2025 版", "a", "text", "2025 版", "2025 版"),
    ("a char() x", "a", "char", "() x", "() x")])
def test_field_lines(spark, line, field, kind, comment, label):
    docs = spark.createDataFrame([(1, f"h3.  t_x 表\nx\n字段\n{line}\npainting the wall\n1a int x\nint\n")], "doc_id int, text string")
    rows = LB.dictionary_fields(LB.text_lines(docs, "doc_id", "text"), text="line").collect()
    assert [(r.table, r.table_title, r.field, r.field_type, r.comment, r.label) for r in rows] == [("t_x", "表", field, kind, comment, label)]


def test_evolving_schema_wide_keys(spark, tmp_path):
    """Keys beyond the narrow types of the old versions."""
    from quaystone.plans.q_sources import q_evolving_schema
    rows = [(3_000_000_000, 70_000, "1996-03-01"), (3_000_000_001, 4_000_000_000, "1997-03-01"), (5, 40_000, "1999-03-01"), (6, None, "1999-03-02")]
    spark.createDataFrame([(k, c, "F", 1.0 * 12.34, d, "1-URGENT") for k, c, d in rows],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string, o_orderpriority string") \
        .selectExpr("* except(d)", "cast(d as timestamp_ntz) as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    out = q_evolving_schema(spark, str(tmp_path))
    assert out.schema["id"].dataType.typeName() == out.schema["customer_id"].dataType.typeName() == "long"
    assert sorted((r.id, r.customer_id) for r in out.collect() if r.customer_id) == sorted((k, c) for k, c, _ in rows if c)
