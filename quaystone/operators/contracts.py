"""Contract-source merge: header detection, total rows, anti join, rule projection,
typing by column name, dedup, renumbering, platform/engineer maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaystone.functions.dates import date_part, merge_date
from quaystone.functions.numbers import number_digits, number_value, parse_number
from quaystone.functions.text import strip_all, text_or_empty

# ---------------------------------------------------------------------------
# Names and rules of the contract extracts.
MONEY_KEYWORDS = ("金额", "价税", "单价", "回款", "开票", "确收", "应分摊")
DATE_FIELDS = ("合同申请日期", "归档日期", "明细运维开始开始日期", "明细运维结束日期")
NUMERIC_FIELDS = ("明细数量", "产品占比")
TEXT_FIELDS = ("免费运维期（月）", "其他业务类型", "无效合同类型", "体系工程师")
EXTRA_OLD_TEXT_COLUMNS = ("其他业务类型", "无效合同类型")
TOTAL_LABEL = "合计"
MAX_HEADER_SCAN_ROWS = 10
NEW_REQUIRED_COLUMNS = ("合同编号", "销售组织", "签约客户", "标的行编码")
OLD_REQUIRED_COLUMNS = ("合同编号", "签署公司", "合同分录ID", "是否标准合同")
OLD_LINE_KEY, NEW_LINE_KEY = "合同分录ID", "企业版销售合同明细id"
SNAPSHOT_KEY_COLUMNS = ("合同编号", "标的行编码", "执行明细id")
SOURCE_COLUMN, GENERATED_AT_COLUMN, SOURCE_DATE_COLUMN = "数据来源", "文件生成时间戳", "文件来源时间戳"
NEW_SOURCE_LABEL, OLD_SOURCE_LABEL = "新ERP", "旧ERP"
DEFAULTS = (("无效合同类型", "有效"), ("其他业务类型", "非税票据"))
INVALID_CONTRACT_NUMBERS = ("", "/")
ZERO_RULE = "旧ERP数据源统一为0"
SPREAD_CONTRACT = "统签散开合同"
ORDINARY_CONTRACT = "普通销售合同"
ESTIMATE_CONTRACT = "运维收入暂估合同"
VIRTUAL_CONTRACT = "虚拟销售合同"
BUSINESS_TYPE_MAP = {
    "运维服务": "运维服务费",
    "实施服务": "实施服务费",
    "SaaS及运营服务": "SAAS运营服务",
    "软件销售": "软件产品",
    "硬件及耗材销售": "其他硬件销售",
    "定制软件开发": "开发服务费",
}
BUSINESS_TYPE_OTHER = "其他"
CONTRACT_CATEGORY_MAP = {"运维合同": "运维合同", "实施合同": "非运维合同"}
CONTRACT_CATEGORY_OTHER = "/"
# Target column -> config key naming the old source column of a shared amount.
SHARED_AMOUNT_TARGETS = {
    "去年同期收入金额": "去年收入基数字段",
    "累计开票金额": "累计开票金额原字段",
    "累计回款金额": "累计回款金额原字段",
}
SHARE_RATIO_KEY = "乘数因子字段"
# ---------------------------------------------------------------------------


def is_money_column(name: str) -> bool:
    return any(k in name for k in MONEY_KEYWORDS)


# -- sources as raw cells ----------------------------------------------------

def read_cells(raw: DataFrame, required: Sequence[str], max_rows: int | None = MAX_HEADER_SCAN_ROWS) -> DataFrame:
    """Raw sheet rows (row_no INT, cells ARRAY<STRING>) -> named text columns.

    The header row is located on the cluster; only that one row's cell names reach the
    driver (bounded by the sheet width). Rows after it become data; unnamed columns and
    all-blank rows are dropped; total rows are dropped (P17)."""
    req = F.array(*[F.lit(r) for r in required])
    cand = raw if max_rows is None else raw.where(F.col("row_no") < max_rows)
    cand = cand.where(F.size(F.array_except(req, F.transform("cells", lambda c: strip_all(c)))) == 0)
    found = cand.agg(F.min("row_no").alias("r"), F.min_by("cells", "row_no").alias("c")).collect()[0]
    hdr, header_cells = found["r"], found["c"]
    if hdr is None:
        raise ValueError(f"no header row containing {sorted(required)}")
    names = [str(c).strip() if c is not None else "" for c in header_cells]
    cols = [F.coalesce(F.get(F.col("cells"), i), F.lit("")).alias(n) for i, n in enumerate(names) if n]
    data = raw.where(F.col("row_no") > hdr).select("row_no", *cols)
    named = [n for n in names if n]
    nonblank = F.lit(False)
    for n in named:
        nonblank = nonblank | (F.col(n) != "")
    return drop_total_rows(data.where(nonblank), named)


def is_total_cell(c) -> Column:
    """'合计' after trailing ':' / '：' are removed (character trim, no regex). Few cells hold the word, so few are trimmed."""
    text = F.col(c) if isinstance(c, str) else c
    return text.cast("string").contains(TOTAL_LABEL) & (F.rtrim(strip_all(text), F.lit(":：")) == TOTAL_LABEL)


def drop_total_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop rows where any cell reads '合计' after trailing ':'/'：' (P17). NULL cells never match."""
    cols = list(columns) if columns is not None else [f.name for f in df.schema.fields
                                                      if f.dataType.simpleString() == "string"]
    if not cols:
        return df
    any_total = F.lit(False)
    for c in cols:
        any_total = any_total | F.coalesce(is_total_cell(c), F.lit(False))
    return df.where(~any_total)


# -- anti join, dedup, renumber ----------------------------------------------

def remove_old_rows_existing_in_new(old: DataFrame, new: DataFrame,
                                    old_key: str = OLD_LINE_KEY, new_key: str = NEW_LINE_KEY) -> DataFrame:
    """Old rows whose trimmed line id appears among the new ids.
    Blank new ids are ignored; blank old ids are kept. A missing key column is an error."""
    if old_key not in old.columns:
        raise KeyError(f"old source lacks {old_key!r}")
    if new_key not in new.columns:
        raise KeyError(f"new source lacks {new_key!r}")
    ids = (new.select(text_or_empty(new_key).alias("__k")).where(F.col("__k") != "").distinct())
    keyed = old.withColumn("__k", text_or_empty(old_key))
    return keyed.join(ids, "__k", "left_anti").drop("__k")


def _order_cols(order, descending: bool) -> list[Column]:
    cols = [F.col(o) for o in order] if isinstance(order, (list, tuple)) else \
        [F.col(order) if isinstance(order, str) else order]
    return [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in cols]


def _top1_per_key(df: DataFrame, key_cols: Sequence[Column], order_cols: Sequence[Column]) -> DataFrame:
    """Exactly one row per key: the first along ``order_cols``.

    ``row_number() = 1`` over the key: Spark plans a partial group limit before the shuffle
    (WindowGroupLimit, after a local sort), so each map task sends at most one row per key;
    a key holding a large share of the rows is reduced map-side like a partial aggregate."""
    names = [f"__k{i}" for i in range(len(key_cols))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(key_cols, names)])
    w = Window.partitionBy(*names).orderBy(*order_cols)
    return keyed.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).select(*df.columns)


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Keep the row with the greatest ``order`` per trimmed key, only where every key part
    is non-blank; rows with an incomplete key are all kept (W1).

    One row per key even when the order ties. ``order`` is a column name, a Column or a list
    of column names. One scan: a row with an incomplete key carries a number of its own as a
    further key part, so it is alone in its group and such rows spread over all partitions."""
    norm = [text_or_empty(k) for k in keys]
    complete = F.lit(True)
    for n in norm:
        complete = complete & (n != "")
    own = F.when(~complete, F.monotonically_increasing_id())
    tagged = df.withColumn("__own", own)
    return _top1_per_key(tagged, [*norm, F.col("__own")], _order_cols(order, descending=True)).drop("__own")


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per non-blank trimmed ``key`` by ``order`` (arrival order); blank keys dropped."""
    k = text_or_empty(key)
    return _top1_per_key(df.where(k != ""), [text_or_empty(key)], _order_cols(list(order), descending=False))


def renumber(df: DataFrame, order: Sequence[str], name: str = "seq_no", partitions: int | None = None) -> DataFrame:
    """Number rows 1..n along a total order without a single-task window.

    Range-partition on the order, sort inside each range and tag each row with its range id
    and its rank inside the range; that tagged frame is written to the shared checkpoint
    folder, so the ranks and the per-range counts read the same rows (a recomputed range
    exchange could split differently). Each row is offset by the running count of earlier
    ranges; only the per-range counts (one row per range) are combined in one place."""
    from quaystone.session import written

    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    # Inside a sorted range the position id (partition index << 33 | row position) gives the
    # local rank directly, so no second shuffle (window per range) is needed.
    pid = F.spark_partition_id()
    ranged = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn("__pid", pid)
                     .withColumn("__r", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33) + 1), "ranged")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__r")).cast("long")) \
              .drop("__pid", "__r", "__off")


def drop_invalid_contracts(df: DataFrame, column: str = "合同编号") -> DataFrame:
    """Drop rows whose contract number is blank or '/' (P18)."""
    return df.where(~text_or_empty(column).isin(*INVALID_CONTRACT_NUMBERS))


def fill_defaults(df: DataFrame, defaults=DEFAULTS) -> DataFrame:
    """Blank text -> default for the listed columns."""
    present = {c: v for c, v in defaults if c in df.columns}
    return df.select(*[
        F.when(text_or_empty(c) == "", F.lit(present[c])).otherwise(text_or_empty(c)).alias(c)
        if c in present else F.col(c) for c in df.columns])


# -- rule expressions (P20-P24) -----------------------------------------------

def contract_type(standard_type: Column) -> Column:
    t = text_or_empty(standard_type)
    return F.when(t == SPREAD_CONTRACT, t).otherwise(F.lit(ORDINARY_CONTRACT))


def yes_no_by_standard_type(standard_type: Column, expected: str) -> Column:
    return F.when(text_or_empty(standard_type) == expected, "是").otherwise("否")


def _mapped(c: Column, mapping: Mapping[str, str], other: str | None) -> Column:
    # a look-up, not a chain of cases: the text is made once
    table = F.create_map(*[F.lit(x).cast("string") for pair in mapping.items() for x in pair])
    return F.coalesce(F.element_at(table, c), F.lit(other).cast("string"))


def business_type(group: Column) -> Column:
    return _mapped(text_or_empty(group), BUSINESS_TYPE_MAP, BUSINESS_TYPE_OTHER)


def contract_category(kind: Column) -> Column:
    return _mapped(text_or_empty(kind), CONTRACT_CATEGORY_MAP, CONTRACT_CATEGORY_OTHER)


def shared_amount(amount: Column, ratio: Column) -> Column:
    """Amount times share ratio, both parsed as money/percent."""
    return parse_number(amount) * parse_number(ratio)


def parsed_columns(df: DataFrame, numbers: Sequence[str], dates: Sequence[str] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """(df with working columns beside its own, the number or merge date of each named
    text column). The stripped texts, and the literals in them, are projections of their own, as the converters look at them
    several times."""
    numbers = list(dict.fromkeys(numbers))
    at = {c: f"__t{i}" for i, c in enumerate([*numbers, *dates])}
    df = df.select("*", *[text_or_empty(F.col(f"`{c}`")).alias(t) for c, t in at.items()])
    df = df.select("*", *[number_digits(F.col(at[c])).alias(f"{at[c]}_") for c in numbers],
                   *[date_part(F.col(at[c])).alias(f"{at[c]}_") for c in dates])
    return df, {c: (number_value(F.col(f"{t}_"), F.col(t)) if c in numbers else merge_date(F.col(t), F.col(f"{t}_")))
                for c, t in at.items()}


def map_or_keep(c: Column, mapping: Mapping[str, str]) -> Column:
    t = text_or_empty(c)
    return t if not mapping else F.coalesce(_mapped(t, mapping, None), t)


# Target -> (word that its rule text holds, old source column), with the expression that fills it.
SPECIAL_RULES = {
    "合同类型": (SPREAD_CONTRACT, "是否标准合同", contract_type),
    "暂估运维运营": (ESTIMATE_CONTRACT, "是否标准合同", lambda c: yes_no_by_standard_type(c, ESTIMATE_CONTRACT)),
    "虚拟合同": (VIRTUAL_CONTRACT, "是否标准合同", lambda c: yes_no_by_standard_type(c, VIRTUAL_CONTRACT)),
    "业务类型": ("核算收入类型分组", "核算收入类型分组", business_type),
    "合同分类": ("合同类型", "合同类型", contract_category),
}


def convert_old_to_new(old: DataFrame, output_columns: Sequence[str], rules: Mapping[str, str],
                       config: Mapping, keep: Sequence[str] = ()) -> DataFrame:
    """Project the old source to the target layout by rule text.

    Each target takes the first that applies: the constants of its rule, its special rule, the platform
    map, a shared amount, the source column named by the rule, '/'. Only the (small) rule dict is
    looked at here; the projection is one ``select``."""
    amounts, platforms = config.get("金额换算", {}), config.get("营销平台映射", {})
    column = {c: F.col(f"`{c}`") for c in old.columns}
    constants = {"/": F.lit("/"), ZERO_RULE: F.lit(0)}
    factors = [amounts.get(k, "") for k in (*SHARED_AMOUNT_TARGETS.values(), SHARE_RATIO_KEY)]
    old, numbers = parsed_columns(old, [c for c in factors if c in column])

    def of(name: str) -> Column:
        return column.get(name, F.lit(""))

    def number(name: str) -> Column:
        return numbers.get(name, F.lit(0.0))

    def filled(target: str, rule: str) -> Column:
        word, source, expression = SPECIAL_RULES.get(target, (None, None, None))
        options = (
            (rule in constants, lambda: constants[rule]),
            (word is not None and word in rule, lambda: expression(of(source))),
            (target == "营销平台" and rule in column, lambda: map_or_keep(column[rule], platforms)),
            (target in SHARED_AMOUNT_TARGETS, lambda: number(amounts.get(SHARED_AMOUNT_TARGETS[target], ""))
             * number(amounts.get(SHARE_RATIO_KEY, ""))),  # amount times share ratio (P21)
            (rule in column, lambda: column[rule]),
        )
        return next((value() for applies, value in options if applies), constants["/"])

    return old.select(*[filled(t, str(rules.get(t) or "").strip()).alias(t) for t in output_columns], *keep)


def align_new(new: DataFrame, output_columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project the new source to the target layout: present column; '' for the two extra text
    columns; 0.0 for money-named columns; else '/' (P23)."""
    src = set(new.columns)
    exprs = []
    for c in output_columns:
        if c in src:
            e = F.col(c)
        elif c in EXTRA_OLD_TEXT_COLUMNS:
            e = F.lit("")
        elif is_money_column(c):
            e = F.lit("0.0")
        else:
            e = F.lit("/")
        exprs.append(e.cast("string").alias(c))
    return new.select(*exprs, *keep)


def type_by_name(df: DataFrame) -> DataFrame:
    """Money-named columns -> number, date fields -> 'yyyyMMdd' text, numeric fields ->
    number ('/' and bad text 0), text fields -> text with NULL as '' (P24). The texts that a converter looks
    at several times are projections of their own."""
    numbers = [c for c in df.columns if is_money_column(c)]
    rows, parsed = parsed_columns(df, numbers, [c for c in df.columns if c in DATE_FIELDS and c not in numbers])
    exprs = []
    for c in df.columns:
        if c in parsed:
            e = parsed[c]
        elif c in NUMERIC_FIELDS:
            t = strip_all(F.col(c))
            e = F.coalesce(F.when(t != "/", t).try_cast("double"), F.lit(0.0))
        elif c in TEXT_FIELDS:
            e = F.coalesce(F.col(c).cast("string"), F.lit(""))
        else:
            e = F.col(c)
        exprs.append(e.alias(c))
    return rows.select(*exprs)


# -- maps (J10-J12) -----------------------------------------------------------

def map_table(spark: SparkSession, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A two-column table from a driver-side config dict (size = len(mapping))."""
    rows = [(str(k), None if v is None else str(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, f"`{key}` string, `{value}` string")


def map_platform(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace a platform by the map (key, value), else keep it trimmed."""
    m = mapping.toDF("__from", "__to")
    j = df.withColumn("__from", text_or_empty(column)).join(m, "__from", "left")
    return j.withColumn(column, F.coalesce(F.col("__to"), F.col("__from"))).drop("__from", "__to")


def add_engineer(df: DataFrame, platform: str, mapping: DataFrame, out: str = "体系工程师") -> DataFrame:
    """Assign the engineer of the platform, '' when unmapped."""
    m = mapping.toDF("__p", "__e")
    j = df.withColumn("__p", text_or_empty(platform)).join(m, "__p", "left")
    return j.withColumn(out, F.coalesce(F.col("__e"), F.lit(""))).drop("__p", "__e")


def apply_baseline_platform(rows: DataFrame, baseline: DataFrame, keys: Sequence[str],
                            platform: str = "sales_platform", date_col: str = "create_date",
                            baseline_date: str | None = None, baseline_order: str | None = None) -> DataFrame:
    """Take the baseline platform (even NULL) for lines whose key exists in the baseline,
    keys matched NULL-safely; rows of the baseline's own date are left alone (J10).
    Adds ``reused_baseline`` (boolean). A key that the baseline repeats counts once, with the last row by
    ``baseline_order`` (without an order, the largest platform)."""
    value = F.struct(F.col(platform).alias("p"))
    last = F.max_by(value, F.struct(F.col(baseline_order), value)) if baseline_order else F.max(value)
    b = baseline.groupBy(*[F.col(k).alias(f"__b_{k}") for k in keys]).agg(last.alias("__b")).select(
        *[f"__b_{k}" for k in keys], F.col("__b.p").alias("__b_platform"), F.lit(True).alias("__b_hit"))
    cond = None
    for k in keys:
        c = rows[k].eqNullSafe(b[f"__b_{k}"])
        cond = c if cond is None else cond & c
    j = rows.join(b, cond, "left")
    own_date = (F.col(date_col) == F.lit(baseline_date)) if baseline_date else F.lit(False)
    hit = F.coalesce(F.col("__b_hit"), F.lit(False)) & ~F.coalesce(own_date, F.lit(False))
    return j.select(
        *[F.when(hit, F.col("__b_platform")).otherwise(F.col(platform)).alias(platform) if c == platform
          else F.col(c) for c in rows.columns],
        hit.alias("reused_baseline"))


def apply_engineer_override(rows: DataFrame, mapping: DataFrame, platform: str = "sales_platform",
                            engineer: str = "system_engineer") -> DataFrame:
    """Engineer from the final platform's map entry; unmatched rows keep theirs.
    Adds ``mapped_engineer`` (boolean)."""
    m = mapping.toDF("__p", "__e")
    j = rows.join(m, rows[platform] == m["__p"], "left")
    return j.select(
        *[F.coalesce(F.col("__e"), F.col(engineer)).alias(engineer) if c == engineer else F.col(c)
          for c in rows.columns],
        F.col("__e").isNotNull().alias("mapped_engineer"))
