import datetime as dt

from quaystone.operators import contracts as C
from quaystone.plans import jobs as J
from quaystone.plans.q_jobs import NEW_HEADER, OLD_HEADER


def _raw(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "row_no int, cells array<string>")


def test_merge_contract_sources_fixture(spark):
    new = _raw(spark, [
        ["说明"] + [""] * 13,
        NEW_HEADER,
        ["NEW-1", "ORG", "C", "I1", "E1", "DUP-1", "甲平台", "2026-01-01", "2026-12-31", "3650", "2026-07-01", "111", "222", ""],
        ["", "", "", "", "", "", "", "", "", "", "", "", "", "合计："],
    ])
    old = _raw(spark, [
        ["说明"] + [""] * 17, ["x"] + [""] * 17, ["y"] + [""] * 17,
        OLD_HEADER,
        ["OLD-DROP", "公司", "DUP-1", "E9", "普通", "运维服务", "运维合同", "旧平台", "1,000", "800", "600", "25%",
         "2026-01-01", "2026-06-30", "1000", "1", "2", ""],
        ["OLD-KEEP", "公司", "L2", "E2", "运维收入暂估合同", "运维服务", "运维合同", "旧平台", "1,000", "800", "600", "25%",
         "2026-01-01", "2026-06-30", "1000", "1", "2", ""],
        ["OLD-KEEP", "公司", "L2", "E2", "运维收入暂估合同", "运维服务", "运维合同", "旧平台", "1,000", "800", "600", "25%",
         "2026-01-01", "2026-06-30", "1000", "1", "2", ""],
        ["", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "合计:"],
    ])
    rules = {"序号": "/", "合同编号": "合同编号", "标的行编码": "合同分录ID", "执行明细id": "执行明细id",
             "企业版销售合同明细id": "合同分录ID", "暂估运维运营": "运维收入暂估合同", "业务类型": "核算收入类型分组",
             "合同分类": "合同类型", "营销平台": "营销平台旧", "累计开票金额": "x", "累计回款金额": "x", "去年同期收入金额": "x",
             "产品金额": "产品金额旧", "明细运维开始开始日期": "运维开始", "明细运维结束日期": "运维结束", "合同申请日期": "/"}
    cfg = {"营销平台映射": {"旧平台": "甲平台"},
           "金额换算": {"乘数因子字段": "分成比例", "累计开票金额原字段": "累计开票金额", "累计回款金额原字段": "累计回款金额",
                        "去年收入基数字段": "累计收入金额-去年同期"}}
    merged = J.merge_contract_sources(new, old, list(rules), rules, cfg, dt.datetime(2026, 7, 15, 9, 0, 0),
                                      ["new_2026-7-15.xlsx", "old_2026-7-1.xlsx"],
                                      C.map_table(spark, cfg["营销平台映射"], "a", "b"),
                                      C.map_table(spark, {"甲平台": "工程师A"}, "p", "e"))
    rows = sorted(merged.collect(), key=lambda r: r["序号"])
    assert [r["合同编号"] for r in rows] == ["NEW-1", "OLD-KEEP"]
    assert [r["序号"] for r in rows] == [1, 2]
    old_row = rows[1]
    assert (old_row["累计开票金额"], old_row["累计回款金额"], old_row["去年同期收入金额"]) == (250.0, 200.0, 150.0)
    assert old_row["暂估运维运营"] == "是" and old_row["业务类型"] == "运维服务费" and old_row["营销平台"] == "甲平台"
    assert old_row["体系工程师"] == "工程师A" and old_row["数据来源"] == "旧ERP"
    assert rows[0]["无效合同类型"] == "有效" and rows[0]["其他业务类型"] == "非税票据"
    assert rows[0]["文件来源时间戳"] == "20260715" and rows[0]["文件生成时间戳"] == "20260715090000"
    assert rows[0]["明细运维开始开始日期"] == "20260101"
    sheet = J.standard_sheet(merged, (dt.date(2025, 1, 1), dt.date(2025, 12, 31)), (dt.date(2026, 1, 1), dt.date(2026, 12, 31)))
    assert len(sheet.columns) == 78
    first = sorted(sheet.collect(), key=lambda r: r["序号"])[0]
    assert first["合同天数"] == 365 and float(first["今年按期分摊服务费"]) == 3650.0
