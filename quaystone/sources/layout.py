"""Column-layout contracts: header checks, by-name and by-position projection, schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contract snapshot layout, 69 legacy columns then 9 allocation columns
# (header text, column name).
LEGACY_LAYOUT = [
    ("序号", "seq_no"), ("合同编号", "contract_id"), ("销售组织", "sales_org"), ("是否初始化", "is_initialized"),
    ("合同名称", "contract_name"), ("合同申请日期", "contract_apply_date"), ("销售业绩部门", "sales_dept"),
    ("申请人", "applicant"), ("销售员", "sales_person"), ("签约客户", "sign_customer"), ("最终客户", "final_customer"),
    ("第三方", "third_party"), ("合同类型", "contract_type"), ("暂估运维运营", "is_estimated_ops"),
    ("虚拟合同", "is_virtual"), ("2026运维saas续签合同", "is_2026_saas_renew"), ("单据状态", "doc_status"),
    ("关闭状态", "close_status"), ("合同执行状态", "exec_status"), ("归档状态", "archive_status"),
    ("归档日期", "archive_date"), ("合同总金额", "total_amount"), ("免费运维期（月）", "free_ops_months"),
    ("年运维约定金额", "annual_ops_amount"), ("城市", "city"), ("省份", "province"),
    ("企业版销售合同明细id", "sales_contract_detail_id"), ("标的行编码", "item_code"), ("标的", "item_name"),
    ("业务类型", "business_type"), ("交付项目编码", "project_code"), ("交付项目", "project_name"),
    ("运维签约类型", "ops_sign_type"), ("明细数量", "detail_qty"), ("销售单价", "unit_price"),
    ("明细价税合计", "detail_amount_with_tax"), ("明细运维开始开始日期", "ops_start_date"),
    ("明细运维结束日期", "ops_end_date"), ("执行明细id", "exec_detail_id"), ("产品物料", "product_material"),
    ("产品占比", "product_ratio"), ("云服务类型", "cloud_service_type"), ("产品金额", "product_amount"),
    ("一级产品线", "product_line1"), ("二级产品线", "product_line2"), ("产品公司", "product_company"),
    ("所属事业部", "division"), ("累计开票金额", "cum_billing"), ("累计回款金额", "cum_collection"),
    ("累计确收金额", "cum_revenue"), ("当年开票金额", "cur_year_billing"), ("去年同期开票金额", "prev_year_billing"),
    ("当年回款金额", "cur_year_collection"), ("去年同期回款金额", "prev_year_collection"),
    ("当年收入金额", "cur_year_revenue"), ("去年同期收入金额", "prev_year_revenue"),
    ("当年应分摊金额", "cur_year_amort"), ("去年同期应分摊金额", "prev_year_amort"), ("营销平台", "sales_platform"),
    ("体系工程师", "system_engineer"), ("是否公有云", "is_public_cloud"), ("是否一次性收入", "is_one_time_revenue"),
    ("合同分类", "contract_category"), ("业务类别", "business_category"), ("其他业务类型", "other_business_type"),
    ("无效合同类型", "invalid_contract_type"), ("数据来源", "data_source"), ("文件生成时间戳", "create_date"),
    ("文件来源时间戳", "file_source_date"),
]
ALLOCATION_LAYOUT = [
    ("合同天数", "contract_days"), ("去年统计起始日期", "prev_year_period_start"),
    ("去年统计截止日期", "prev_year_period_end"), ("去年按期分摊服务费", "prev_year_calc_amort"),
    ("去年倒签调整后分摊服务费", "prev_year_adjusted_amort"), ("今年统计起始日期", "cur_year_period_start"),
    ("今年统计截止日期", "cur_year_period_end"), ("今年按期分摊服务费", "cur_year_calc_amort"),
    ("今年倒签调整后分摊服务费", "cur_year_adjusted_amort"),
]
STANDARD_LAYOUT = LEGACY_LAYOUT + ALLOCATION_LAYOUT


def check_layout(columns: Sequence[str], layouts: Sequence[Sequence[str]]) -> list[str]:
    """Header contract (S6): the header *set* must equal one accepted layout, with no duplicate
    and no blank name. Returns the matching layout (in layout order); raises otherwise.
    Runs on column names only."""
    names = [str(c).strip() for c in columns]
    if len(names) != len(set(names)):
        dups = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"duplicate columns: {dups}")
    for layout in layouts:
        if set(names) == set(layout) and len(names) == len(layout):
            return list(layout)
    raise ValueError("columns match no accepted layout: "
                     f"missing {sorted(set(layouts[-1]) - set(names))}, extra {sorted(set(names) - set(layouts[-1]))}")


def matching_sheet(sheets: Mapping[str, Sequence[str]], layouts: Sequence[Sequence[str]]) -> str:
    """The one sheet (name -> headers) of a workbook whose headers are an accepted layout (S6); none or several
    is an error, and so is a sheet with all headers of a layout of which one occurs twice."""
    whole = {name: [str(c).strip() for c in headers if str(c or "").strip()] for name, headers in sheets.items()}
    accepted = [set(layout) for layout in layouts]
    found = [name for name, headers in whole.items() if set(headers) in accepted]
    twice = [name for name in found if len(whole[name]) != len(set(whole[name]))]
    if twice:
        raise ValueError(f"duplicate columns in {twice}")
    if len(found) != 1:
        raise ValueError(f"one matching sheet expected, found {found} among {list(sheets)}")
    return found[0]


def project_by_name(df: DataFrame, contract: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """Project to ``contract`` by name; absent columns are NULL."""
    types = types or {}
    cols = []
    for c in contract:
        e = F.col(f"`{c}`") if c in df.columns else F.lit(None)
        cols.append(e.cast(types.get(c, "string")).alias(c))
    return df.select(*cols)


def project_by_position(df: DataFrame, cells: str, names: Sequence[str]) -> DataFrame:
    """Cells array -> named columns by position; short rows padded with NULL."""
    return df.select(*[F.get(F.col(cells), i).alias(n) for i, n in enumerate(names)])


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required headers present (S9) and all-blank rows dropped."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    nonblank = F.lit(False)
    for c in df.columns:
        nonblank = nonblank | F.coalesce(F.trim(F.col(f"`{c}`").cast("string")) != "", F.lit(False))
    return df.where(nonblank)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union with schema evolution (S18): columns only in one side are NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


# -- files of differing schemas (S18) ---------------------------------------------------------

#: Whole numbers in order of width, and the decimal digits that each may need.
_WHOLE = {"byte": 3, "short": 5, "integer": 10, "long": 19}
_REAL = ("float", "double")
_TIMES = ("date", "timestamp_ntz", "timestamp")


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: int to long to decimal, any number with a double to double, date to timestamp,
    structs field by field, arrays and maps by their elements, anything else to text."""
    if a == b:
        return a
    one, two = a.typeName(), b.typeName()
    if "void" in (one, two):
        return b if one == "void" else a
    if one in _WHOLE and two in _WHOLE:
        return a if _WHOLE[one] > _WHOLE[two] else b
    digits = lambda t: (_WHOLE[t.typeName()], 0) if t.typeName() in _WHOLE else (t.precision - t.scale, t.scale)
    exact = lambda t: t.typeName() in _WHOLE or t.typeName() == "decimal"
    if exact(a) and exact(b):
        whole, scale = (max(x) for x in zip(digits(a), digits(b)))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if (exact(a) or one in _REAL) and (exact(b) or two in _REAL):
        return T.DoubleType()
    if one in _TIMES and two in _TIMES:
        return max((a, b), key=lambda t: _TIMES.index(t.typeName()))
    if one == two == "struct":
        return widest_schema([a, b])
    if one == two == "array":
        return T.ArrayType(wider_type(a.elementType, b.elementType))
    if one == two == "map":
        return T.MapType(wider_type(a.keyType, b.keyType), wider_type(a.valueType, b.valueType))
    return T.StringType()


def widest_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Every field of the schemas, in order of first appearance, as wide as its widest occurrence."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            fields[f.name] = wider_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _widened(value: Column, has: T.DataType, wanted: T.DataType) -> Column:
    if has == wanted:
        return value
    kind = has.typeName()
    if wanted.typeName() == "string" and kind in ("struct", "array", "map"):
        return F.to_json(value)
    if kind == "struct":
        held = {f.name: f.dataType for f in has.fields}
        parts = [(_widened(value[f.name], held[f.name], f.dataType) if f.name in held
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if kind == "array":
        return F.transform(value, lambda x: _widened(x, has.elementType, wanted.elementType))
    if kind == "map":
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            _widened(e["key"], has.keyType, wanted.keyType), _widened(e["value"], has.valueType, wanted.valueType)))
        return F.map_from_entries(entries)
    return value.cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a wider schema; absent columns are NULL."""
    held = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(_widened(F.col(f"`{f.name}`"), held[f.name], f.dataType) if f.name in held
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_versions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet folders whose schemas differ, as one table in the widest schema (S18). The footers give the schemas;
    each folder is scanned once with its own, so filters and columns still reach the scans."""
    frames = [spark.read.parquet(p) for p in paths]
    schema = widest_schema([f.schema for f in frames])
    return reduce(DataFrame.unionByName, [conform(f, schema) for f in frames])
