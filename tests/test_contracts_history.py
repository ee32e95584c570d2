import datetime as dt

from pyspark.sql import functions as F

from quaystone.operators import contracts as C
from quaystone.operators import history as H
from quaystone.operators import tickets as T


def test_read_cells_header_and_totals(spark):
    raw = spark.createDataFrame([
        (0, ["说明", None, None]), (1, [None, None, None]), (2, [" 合同编号 ", "签署公司", ""]),
        (3, ["C1", "X", "ignored"]), (4, ["", "", ""]), (5, ["C2", "合计：", None]), (6, ["C3", "Y", None])],
        "row_no int, cells array<string>")
    out = C.read_cells(raw, ["合同编号", "签署公司"])
    assert sorted(r["合同编号"] for r in out.collect()) == ["C1", "C3"]
    assert "row_no" in out.columns and len(out.columns) == 3


def test_anti_join_blank_ids(spark):
    old = spark.createDataFrame([("a",), (" b ",), ("",), ("c",)], f"`{C.OLD_LINE_KEY}` string")
    new = spark.createDataFrame([("b",), ("",)], f"`{C.NEW_LINE_KEY}` string")
    kept = sorted(r[0] for r in C.remove_old_rows_existing_in_new(old, new).collect())
    assert kept == ["", "a", "c"]


def test_dedup_keep_last_incomplete_keys(spark):
    df = spark.createDataFrame([("k", "i", "d", 1), ("k", "i", "d", 2), ("k", "", "d", 3), ("k", "", "d", 4)],
                               "a string, b string, c string, seq int")
    got = sorted(r.seq for r in C.dedup_keep_last(df, ["a", "b", "c"], "seq").collect())
    assert got == [2, 3, 4]


def test_renumber_contiguous(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = sorted(r.seq_no for r in C.renumber(df, ["k"], partitions=4).collect())
    assert got == list(range(1, 1001))
    ordered = C.renumber(df, ["k"], partitions=4).orderBy("seq_no").collect()
    assert [r.k for r in ordered] == sorted(r.k for r in ordered)


def test_rule_projection(spark):
    old = spark.createDataFrame([("统签散开合同", "运维服务", "运维合同", "河南分公司", "1,000", "25%")],
                                "`是否标准合同` string, `核算收入类型分组` string, `合同类型` string, `营销平台旧` string,"
                                " `累计开票金额` string, `分成比例` string")
    rules = {"合同类型": "统签散开合同…", "业务类型": "核算收入类型分组", "合同分类": "合同类型", "营销平台": "营销平台旧",
             "累计开票金额": "x", "备注": "/", "合同总金额": C.ZERO_RULE, "其他": "不存在的列"}
    cfg = {"营销平台映射": {"河南分公司": "北京分公司"}, "金额换算": {"乘数因子字段": "分成比例", "累计开票金额原字段": "累计开票金额"}}
    r = C.convert_old_to_new(old, list(rules), rules, cfg).first()
    assert (r["合同类型"], r["业务类型"], r["合同分类"], r["营销平台"]) == ("统签散开合同", "运维服务费", "运维合同", "北京分公司")
    assert r["累计开票金额"] == 250.0 and r["备注"] == "/" and r["合同总金额"] == 0 and r["其他"] == "/"


def _batch(spark, rows):
    df = spark.createDataFrame(rows, "id string, phone string")
    return df.withColumn("row_hash", H.row_hash(["id", "phone"]))


def test_scd2_replay_idempotent_and_intervals(spark):
    b1 = _batch(spark, [("1", "a"), ("2", "b")])
    b2 = _batch(spark, [("1", "a"), ("2", "c"), ("3", "d")])
    h = H.empty_history(b1)
    h, _ = H.scd2_apply(h, b1, "id", "B1", dt.datetime(2026, 1, 1))
    h, out = H.scd2_apply(h, b2, "id", "B2", dt.datetime(2026, 2, 1))
    assert {r.id: r.outcome for r in out.collect()} == {"1": "unchanged", "2": "changed", "3": "inserted"}
    h2, out2 = H.scd2_apply(h, b2, "id", "B2", dt.datetime(2026, 2, 1))
    assert {r.outcome for r in out2.collect()} == {"unchanged"}
    rows = sorted(map(tuple, h.select("id", "version_no", "is_current", "effective_to").collect()))
    assert rows == sorted(map(tuple, h2.select("id", "version_no", "is_current", "effective_to").collect()))
    cur = h.where("is_current").groupBy("id").count().collect()
    assert all(r["count"] == 1 for r in cur)
    v2 = {(r.id, r.version_no): r for r in h.collect()}
    assert v2[("2", 1)].effective_to == v2[("2", 2)].effective_from


def test_row_hash_changes_with_phone(spark):
    a = _batch(spark, [("1", "a"), ("1", "b"), ("1", "a")]).collect()
    assert a[0].row_hash == a[2].row_hash != a[1].row_hash


def test_snapshot_upsert_twice_is_stable(spark):
    cur = spark.createDataFrame([("c1", "i1", 10), ("c2", "i2", 20)], "c string, i string, v int")
    ch = spark.createDataFrame([("c1", "i1", 11, 1), ("c1", "i1", 12, 2), ("c3", None, 30, 3), ("c2", "i2", 20, 4)],
                               "c string, i string, v int, o int")
    once = H.snapshot_upsert(cur, ch, ["c", "i"], "o", ["v"])
    got = {(r.c, r.i): (r.v, r.outcome) for r in once.collect()}
    assert got == {("c1", "i1"): (12, "updated"), ("c2", "i2"): (20, "unchanged"), ("c3", None): (30, "inserted")}
    twice = H.snapshot_upsert(once.drop("outcome"), ch, ["c", "i"], "o", ["v"])
    assert sorted((r.c, r.i, r.v) for r in twice.collect() if r.i is not None) == \
        sorted((r.c, r.i, r.v) for r in once.collect() if r.i is not None)


def test_dimension_fold_golden(spark):
    rows = [(1, [("所在地区", "420000 湖北省"), ("城市", "武汉市"), ("客户性质", "正式客户")]),
            (2, [("省份", ""), ("区县", "北京市"), ("市", "110100 北京市")]),
            (3, [("产品名称", "[]"), ("产品线", "财政"), ("工单类别", "子单")])]
    df = spark.createDataFrame(rows, "id int, f array<struct<key:string,value:string>>")
    a = {r.id: r for r in T.extract_dimensions(df, "f").collect()}
    assert (a[1].province, a[1].region_text, a[1].district, a[1].city) == ("湖北省", "湖北省", None, "武汉市")
    assert a[1].customer_type == "正式客户"
    # a blank value stops the field; a province-looking district goes to province;
    # '市' then falls through to city because province is filled
    assert a[2].province == "北京市" and a[2].district is None and a[2].city == "北京市"
    assert a[3].product_line == "财政" and a[3].ticket_category == "子单"


def test_stratified_sample_stable_under_repartition(spark):
    from quaystone.operators.sampling import stratified_sample
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 7).alias("s"))
    a = {(r.s, r.id) for r in stratified_sample(df, ["s"], "id", 5, seed="7").collect()}
    b = {(r.s, r.id) for r in stratified_sample(df.repartition(13, "id"), ["s"], "id", 5, seed="7").collect()}
    c = {(r.s, r.id) for r in stratified_sample(df, ["s"], "id", 5, seed="8").collect()}
    assert a == b and len(a) == 35 and a != c
    small = spark.range(3).select(F.col("id"), F.lit(1).alias("s"))
    assert stratified_sample(small, ["s"], "id", 5).count() == 3


def test_dedup_plans_agree_on_unique_order(spark):
    df = spark.createDataFrame([("k", "i", "d", 1, "a"), ("k", "i", "d", 2, "b"), ("k", " i ", "d", 3, "c"),
                                ("k", None, "d", 4, "e"), ("x", "y", "z", 5, "f")],
                               "a string, b string, c string, seq int, v string")
    slow = sorted(map(tuple, C.dedup_keep_last(df, ["a", "b", "c"], "seq").collect()), key=str)
    fast = sorted(map(tuple, C.dedup_keep_last(df, ["a", "b", "c"], ["seq"]).collect()), key=str)
    assert slow == fast and [r[3] for r in sorted(fast, key=lambda r: r[3])] == [3, 4, 5]


def test_rule_and_typing_texts_are_trimmed_once(spark):
    def trims(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("trim(")

    df = spark.createDataFrame([(" 实施服务 ", " 1,200 ", "2026/7/5 10:00"), ("x", "5 %", "20260230"), (None, "/", "2026-02-30")],
                               "a string, b string, c string").toDF("核算收入类型分组", "产品金额", "合同申请日期")
    group = df.select(C.business_type(F.col("核算收入类型分组")).alias("x"))
    assert [r.x for r in group.collect()] == ["实施服务费", "其他", "其他"]
    assert trims(group) == 1
    typed = C.type_by_name(df.select("产品金额", "合同申请日期"))
    assert [tuple(r) for r in typed.collect()] == [(1200.0, "20260705"), (0.05, "20260230"), (0.0, "2026-02-30")]
    # one of each text, and the two of the literal in an amount
    assert trims(typed) == 4
