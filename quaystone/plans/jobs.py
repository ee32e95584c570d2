"""Composite jobs, each a composition of the operators.

Jobs take DataFrames and parameters and return DataFrames (or a dict of them); writes are
left to the caller (``sources.sinks``) except where the job is the write (G2/G3/G5 return the
new table state, to be written with a partition overwrite after a checkpoint).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.functions.codes import ANALYTIC_FIELD_KEYWORDS, TICKET_ENUMS
from quaystone.functions.dates import (
    month_columns, strict_datetime, stripped_date, unix_text_to_display,
)
from quaystone.functions.numbers import parse_decimal_text, plain_number, stripped_int, without_commas
from quaystone.functions.text import blank_to_null, first_nonempty, strip_all, text_or_empty
from quaystone.operators import allocation, contracts as C, history as H, revenue as R, sampling as S
from quaystone.operators import tickets as T, views as V, worktime as W
from quaystone.operators.entities import canonical_rows
from quaystone.operators.labels import label_columns
from quaystone.sources import layout as L
from quaystone.session import unwritten, written
from quaystone.sources.sinks import raw_archive, write_json_report


# -- G1 / G2 tickets ------------------------------------------------------------------

# (id column, kind of the referenced row, name column): plain references of a ticket.
REFERENCES = (("custUserId", "contact", "cust_user_name"), ("servicerUserId", "agent", "servicer_user_name"),
              ("createrId", "agent", "creater_name"), ("deleterId", "agent", "deleter_name"),
              ("servicerGroupId", "group", "servicer_group_name"),
              ("ticketTemplateId", "template", "ticket_template_name"))
ID_LISTS = (("ccUserIdList", "agent"), ("ccGroupIdList", "group"))


def _reference_names(contacts, companies, agents, groups, templates, field_options, global_options,
                     field_names) -> DataFrame:
    """(kind, id) -> (name, company id, company name), one row per id of each kind; blank ids and names leave
    no row. The company of a contact is joined here, on the dimension side."""
    none = F.lit(None).cast("string")

    def rows(df, kind, id_col, name, company=none, company_name=none):
        return df.select((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
                         F.col(id_col).cast("string").alias("id"), blank_to_null(name).alias("name"),
                         company.alias("company_id"), company_name.alias("company_name"))

    company_id = text_or_empty(F.col("companyId")) if "companyId" in contacts.columns else F.lit("")
    c = contacts.withColumn("__company", F.when(~company_id.isin("", "0"), company_id))
    if companies is not None:
        names = companies.groupBy(F.col("id").cast("string").alias("__cid")).agg(F.min("name").alias("__cn"))
        c = c.join(names, F.col("__company") == F.col("__cid"), "left")
    else:
        c = c.withColumn("__cn", none)
    company_name = F.coalesce(blank_to_null("__cn"), F.col("__company"))
    contact = rows(c, "contact", "cId", "realName", F.col("__company"), company_name)
    contact = contact.withColumn("name", F.coalesce("name", "id"))  # a contact without a name still has a company
    both = (contact.unionByName(rows(agents, "agent", "sId", "name")).unionByName(rows(groups, "group", "gId", "name"))
            .unionByName(rows(templates, "template", "tId", "name"))
            .unionByName(rows(field_options, F.concat(F.lit("field:"), F.col("field_key")), "option_key", "option_value"))
            .unionByName(rows(global_options, "option", "option_key", "option_value"))
            .unionByName(rows(field_names, "field", "key", "name")))
    return both.where("id != '' AND name IS NOT NULL").groupBy("kind", "id").agg(
        F.min(F.struct("name", "company_id", "company_name")).alias("ref"))


#: Times that the names of a kind are repeated for the look-up, so that an id that many tickets share is spread over as many
#: tasks: a few for the kinds with many ids.
SHARED_TIMES, OTHER_SHARED_TIMES = {"contact": 2, "agent": 8}, 64


def _reference(kind, i) -> Column:
    """One text for a kind and a trimmed id, NULL without an id; the length of the kind keeps the two apart."""
    head = F.lit(f"{len(kind)}:{kind}") if isinstance(kind, str) else F.concat(F.char_length(kind).cast("string"), F.lit(":"), kind)
    return F.concat(head, i)


def _field_dictionary(details: DataFrame, fields: str, field_names: DataFrame) -> DataFrame:
    """(name, code) of the names that the custom fields get: their distinct keys, named."""
    keys = details.select(F.explode(F.col(f"{fields}.key")).alias("key")).distinct()
    named = field_names.select(F.col("key").cast("string").alias("__id"), blank_to_null("name").alias("__name")) \
        .groupBy("__id").agg(F.min("__name").alias("__name"))
    names = keys.join(named, strip_all("key") == F.col("__id"), "left").select(F.coalesce("__name", "key").alias("name"))
    # both spellings: a blank key keeps itself
    return T.name_codes(names.unionByName(keys.select(F.col("key").alias("name"))).distinct())


def resolve_tickets(details: DataFrame, *, contacts: DataFrame, agents: DataFrame, groups: DataFrame,
                    templates: DataFrame, field_options: DataFrame, global_options: DataFrame,
                    field_names: DataFrame, companies: DataFrame | None = None, key: str = "ticketId",
                    fields: str = "custom_fields") -> DataFrame:
    """G1: enums, contact and its company, agent / group / template names, cc lists, custom fields with
    agent-valued ones (J7), current node and its time, analytic dimensions.

    ``details`` carries the API keys as text and ``custom_fields`` as array<struct<key,value>>. A ticket's
    distinct references of all kinds are exploded once and inner joined with the names of all kinds (rows
    without an id never meet the join); the names found come back as one small map per ticket, and the rest
    are expressions over the ticket's own columns. An id that many tickets share is spread over ``SHARED_TIMES`` tasks. Adds ``resolved_fields``. Unknown or blank references
    keep their ids."""
    t = T.decode_enums(details, {c: m for c, m in TICKET_ENUMS.items() if c in details.columns})
    has = set(details.columns)
    ref = lambda kind, i: _reference(kind, F.nullif(strip_all(i.cast("string")), F.lit("")))
    agent_field = lambda k: F.coalesce(k.startswith(T.AGENT_FIELD_PREFIX), F.lit(False))

    def value_refs(k, value):
        value = value.cast("string")
        parts = F.coalesce(T.json_list(value), F.map_values(T.json_object(value)), F.array(value))
        plain = F.flatten(F.transform(parts, lambda v: F.array(
            ref(F.concat(F.lit("field:"), F.coalesce(k, F.lit(""))), v), ref("option", v))))
        named = F.transform(parts, lambda v: ref("agent", v))
        return F.concat(F.array(ref("field", k)), F.when(agent_field(k), named).otherwise(plain))

    wanted = [F.array(*[ref(kind, F.col(c)) for c, kind, _ in REFERENCES if c in has])]
    list_refs = lambda kind, ids: F.transform(ids, lambda v: ref(kind, v))
    wanted += [list_refs(kind, T.split_id_list(c)) for c, kind in ID_LISTS if c in has]
    if "currentNodeField" in has:
        wanted.append(value_refs(F.col("currentNodeField"), F.col("currentNodeFieldValue")))
    empty = F.array().cast(details.schema[fields].dataType)
    wanted.append(F.flatten(F.transform(F.coalesce(F.col(fields), empty), lambda f: value_refs(f["key"], f["value"]))))
    refs = details.select(key, F.explode(F.array_distinct(F.concat(*wanted))).alias("__r")).where("__r IS NOT NULL")
    names = _reference_names(contacts, companies, agents, groups, templates, field_options, global_options, field_names)
    times = F.lit(OTHER_SHARED_TIMES)
    for kind, n in SHARED_TIMES.items():
        times = F.when(F.col("kind") == kind, n).otherwise(times)
    dims = names.select(_reference(F.col("kind"), F.col("id")).alias("__r"), "ref", F.explode(F.sequence(F.lit(0), times - 1)).alias("__turn"))
    # the same turns on the side of the tickets: the kind of a reference is told by its head
    turns = F.lit(OTHER_SHARED_TIMES)
    for kind, n in SHARED_TIMES.items():
        turns = F.when(F.col("__r").startswith(f"{len(kind)}:{kind}"), n).otherwise(turns)
    refs = refs.withColumn("__turn", F.pmod(F.xxhash64(key), turns).cast("int"))
    found = refs.join(dims, ["__r", "__turn"]).groupBy(key).agg(F.map_from_entries(F.collect_set(
        F.struct("__r", "ref"))).alias("__names"))
    t = t.join(found, key, "left")

    at = lambda kind, i: F.try_element_at(F.col("__names"), ref(kind, i))
    list_names = lambda kind, ids: F.transform(ids, lambda v: F.coalesce(at(kind, v)["name"], v))
    new = {}
    for c, kind, out in REFERENCES:
        if c in has:
            i = blank_to_null(c)
            valid = i.isNotNull() if kind == "contact" else i.isNotNull() & (i != "0")
            new[out] = F.when(valid, F.coalesce(at(kind, i)["name"], i))
    if "custUserId" in has:
        new["company_id"] = at("contact", F.col("custUserId"))["company_id"]
        new["company_name"] = at("contact", F.col("custUserId"))["company_name"]
    for c, kind in ID_LISTS:
        if c in has:
            ids = T.split_id_list(c)
            new[c] = F.when(F.size(ids) > 0, F.array_join(list_names(kind, ids), ",")).otherwise(F.col(c))

    def decoded(k, value):
        value = value.cast("string")
        listed, objects = T.json_list(value), T.json_object(value)

        def option(v):
            return F.coalesce(at(F.concat(F.lit("field:"), F.coalesce(k, F.lit(""))), v)["name"], at("option", v)["name"], v)

        def agent(v):
            return F.coalesce(at("agent", v)["name"], v)

        agents_ = F.when(listed.isNotNull(), F.to_json(F.transform(listed, agent))).otherwise(agent(value))
        options = (F.when(listed.isNotNull(), F.to_json(F.transform(listed, option)))
                   .when(objects.isNotNull(), F.to_json(F.transform_values(objects, lambda _, v: option(v))))
                   .otherwise(option(value)))
        return F.when(agent_field(k), agents_).otherwise(options)

    def named(k):
        return F.coalesce(at("field", k)["name"], k)

    if "currentNodeField" in has:
        new["currentNodeField"] = named(F.col("currentNodeField"))
        new["currentNodeFieldValue"] = decoded(F.col("currentNodeField"), F.col("currentNodeFieldValue"))
    if "nodeFieldIntoTime" in has:
        new["nodeFieldIntoTime"] = unix_text_to_display("nodeFieldIntoTime")
        own = F.col("current_node_started_at") if "current_node_started_at" in has else F.lit(None).cast("string")
        new["current_node_started_at"] = F.coalesce(blank_to_null(own), blank_to_null(new["nodeFieldIntoTime"]))
    new["resolved_fields"] = F.transform(F.col(fields), lambda f: F.struct(
        named(f["key"]).alias("key"), decoded(f["key"], f["value"]).alias("value")))
    kept = [new.pop(c).alias(c) if c in new else F.col(c) for c in t.columns if c != "__names"]
    t = t.select(*kept, *[e.alias(c) for c, e in new.items()])
    return T.extract_dimensions(t.drop(*[d for d in ANALYTIC_FIELD_KEYWORDS if d in has]), "resolved_fields",
                                dictionary=_field_dictionary(details, fields, field_names))


def custom_field_rows(details: DataFrame, key: str, fields: str = "custom_fields") -> DataFrame:
    """EAV rows (key, field_order, field_key, field_value) of the raw custom fields."""
    return details.select(key, F.posexplode(fields).alias("__p", "__f")).select(
        key, (F.col("__p") + 1).alias("field_order"), F.col("__f.key").alias("field_key"),
        F.col("__f.value").alias("field_value"))


def touched_partitions(stored: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The rows of ``stored`` whose partition ``column`` occurs in ``batch``, the NULL partition included.
    The equi semi join prunes partitions when it runs."""
    parts = batch.select(column).distinct()
    null_part = parts.where(F.col(column).isNull()).select(F.lit(1).alias("__null"))
    keep = stored.join(parts, column, "left_semi").select(*stored.columns)
    return keep.unionByName(stored.where(F.col(column).isNull()).withColumn("__null", F.lit(1))
                            .join(null_part, "__null", "left_semi").select(*stored.columns))


def ingest_tickets(incoming: DataFrame, stored_main: DataFrame, stored_child: DataFrame, resolve_args: Mapping,
                   key: str = "ticketId", arrival: str | None = None) -> dict[str, DataFrame]:
    """First row per ticket id in ``arrival`` order (W2), incremental filter, resolve, main rows and
    custom-field rows, upsert on (ticket_id, create_dt) where the stored tables hold both, counts.

    Rows whose id isn't a number are ``rejects`` and count as failed; a loaded ticket counts as updated when
    its id is stored, else as inserted. When the stored tables carry ``create_month_label`` (their partition
    column), only the months that the loaded tickets touch are read and returned, to be written back with a
    dynamic partition overwrite. The marked and the resolved batch are written to the shared checkpoint folder: each feeds several outputs."""
    order = arrival or "__arrival"
    seen = incoming if arrival else incoming.withColumn(order, F.monotonically_increasing_id())
    typed = seen.withColumn("ticket_id", strip_all(F.col(key).cast("string")).try_cast("long")) \
        .withColumn("__upd", strict_datetime("updateDT"))
    rejects = typed.where(F.col("ticket_id").isNull())
    first = C.keep_first(typed.where(F.col("ticket_id").isNotNull()).withColumn("__id", F.col("ticket_id").cast("string")),
                         "__id", [order])
    marked = written(H.incremental_filter(first, stored_main, "ticket_id", "__upd", known="__known"), "marked")
    load = marked.where(F.col("action") == "load").select(*incoming.columns)
    resolved = written(resolve_tickets(load, key=key, **resolve_args), "resolved")
    main = T.wide_main_row(resolved)
    stamp = strict_datetime("createDT")
    child = T.zip_custom_fields(resolved.withColumn("ticket_id", F.col(key).cast("long"))
                                .withColumn("ticket_template_id", blank_to_null("ticketTemplateId"))
                                .withColumn("create_dt", stamp),
                                ["ticket_id", "ticket_template_id", "create_dt"], "custom_fields", "resolved_fields")
    child = child.select("*", *month_columns("create_dt"))
    stored_key = ["ticket_id"] + ["create_dt"] * ("create_dt" in stored_main.columns and "create_dt" in stored_child.columns)
    if "create_month_label" in stored_main.columns:
        stored_main = touched_partitions(stored_main, main, "create_month_label")
        if "create_month_label" in stored_child.columns:
            stored_child = touched_partitions(stored_child, main, "create_month_label")
    main = main.select(*[F.col(c) if c in main.columns else F.lit(None).alias(c) for c in stored_main.columns])
    child = child.select(*[F.col(c) if c in child.columns else F.lit(None).alias(c) for c in stored_child.columns])
    # a ticket without fields still replaces its stored field rows: the main rows name the changed tickets
    new_main, new_child = H.ticket_upsert(stored_main, stored_child, main, child, stored_key)
    outcomes = marked.select(F.when(F.col("action") != "load", "skipped").when(F.col("__known"), "updated")
                             .otherwise("inserted").alias("outcome")) \
        .unionByName(rejects.select(F.lit("failed").alias("outcome")))
    return {"main": new_main, "child": new_child, "counts": H.outcome_counts(outcomes), "rejects": rejects}


# -- G3 entities ----------------------------------------------------------------------

def sync_entities(sources: Sequence[tuple[str, DataFrame]], candidates: Mapping, history: DataFrame, *,
                  key: str, batch_id: str, batch_time, entity_type: str, hash_fields: Sequence[str],
                  allow_empty: bool = False, arrival: str | None = None) -> dict[str, DataFrame]:
    """Canonical rows per source, first id wins across sources (arrival order), row hash,
    empty-source guard, SCD2 apply, raw archive under the canonical id and outcome counts (rows
    without an id are failed). ``arrival`` names the column that orders the rows of a source, where
    the sources have one."""
    canon = None
    for rank, (name, df) in enumerate(sources):
        place = F.col(arrival) if arrival else F.monotonically_increasing_id()
        rows = canonical_rows(df.withColumn("__pos", place), candidates, name, keep=["__pos"]) \
            .withColumn("__src", F.lit(rank))
        canon = rows if canon is None else canon.unionByName(rows)
    good = canon.where(~F.col("rejected"))
    if good.isEmpty() and not allow_empty:
        raise ValueError(f"{entity_type}: no records fetched; nothing written")
    first = C.keep_first(good, key, ["__src", "__pos"]).drop("__src", "__pos", "rejected")
    hashed = first.withColumn("row_hash", H.row_hash(hash_fields, ["source_updated_at"]))
    # replay guard by key: a key that the history has from this time on keeps its versions, new keys are loaded
    new_hist, outcomes = H.scd2_apply(history, hashed, key, batch_id, batch_time, guard=True)
    archive = None
    for name, df in sources:
        a = raw_archive(df, batch_id, entity_type, name, first_nonempty(df, *candidates[key]))
        archive = a if archive is None else archive.unionByName(a)
    rejects = canon.where(F.col("rejected"))
    done = outcomes.select("outcome").unionByName(rejects.select(F.lit("failed").alias("outcome")))
    return {"history": new_hist, "outcomes": outcomes, "counts": H.outcome_counts(done),
            "archive": archive, "rejects": rejects}


# -- G4 / G5 contracts ------------------------------------------------------------------

def merge_contract_sources(new_cells: DataFrame, old_cells: DataFrame, output_columns: Sequence[str],
                           rules: Mapping[str, str], config: Mapping, generated_at: _dt.datetime,
                           file_names: Sequence[str], platform_map: DataFrame, engineer_map: DataFrame) -> DataFrame:
    """Both extracts -> one merged frame in the target layout (text/number columns),
    in the order: anti join, align/convert, union (new first), engineer, money, dates, numbers,
    text, dedup on the snapshot key, invalid-number drop, renumber, defaults, stamps."""
    new = C.read_cells(new_cells, C.NEW_REQUIRED_COLUMNS)
    old = C.read_cells(old_cells, C.OLD_REQUIRED_COLUMNS)
    old = C.remove_old_rows_existing_in_new(old, new)
    cols = list(output_columns)
    if "体系工程师" not in cols:
        cols.insert(cols.index("营销平台") + 1 if "营销平台" in cols else len(cols), "体系工程师")
    for extra in C.EXTRA_OLD_TEXT_COLUMNS:
        if extra not in cols:
            cols.append(extra)
    rules = dict(rules)
    rules.setdefault("体系工程师", "")
    for extra in C.EXTRA_OLD_TEXT_COLUMNS:
        rules.setdefault(extra, extra)
    # the sheet row number orders rows within a source (kept exact: it may not fit a BIGINT)
    new_a = C.align_new(new.withColumn("__seq", F.col("row_no").cast("decimal(38,0)")), cols, keep=["__seq"]) \
        .withColumn("__src", F.lit(0)).withColumn(C.SOURCE_COLUMN, F.lit(C.NEW_SOURCE_LABEL))
    old_c = C.convert_old_to_new(old.withColumn("__seq", F.col("row_no").cast("decimal(38,0)")), cols, rules, config,
                                 keep=["__seq"])
    old_c = old_c.select(*[F.col(c).cast("string") for c in cols], "__seq") \
        .withColumn("__src", F.lit(1)).withColumn(C.SOURCE_COLUMN, F.lit(C.OLD_SOURCE_LABEL))
    merged = new_a.unionByName(old_c.select(*new_a.columns))
    if "营销平台" in merged.columns:
        merged = C.add_engineer(merged, "营销平台", engineer_map, "体系工程师")
    merged = C.type_by_name(merged)
    # Cut lineage here: the typed, merged frame is written to the shared checkpoint folder
    # (spark.checkpoint.dir). Downstream plans start from it, which keeps optimisation
    # cheap and makes the dedup/renumber stages restartable without re-reading both sources. What a stage has
    # written is deleted when the next one has been, so that two tables and one shuffle of the rows are on disk at most.
    merged = typed = written(merged, "merged")
    order = F.struct("__src", "__seq")
    if set(C.SNAPSHOT_KEY_COLUMNS) <= set(merged.columns):
        merged = C.dedup_keep_last(merged.withColumn("__ord", order), C.SNAPSHOT_KEY_COLUMNS, "__ord").drop("__ord")
    if "合同编号" in merged.columns:
        merged = C.drop_invalid_contracts(merged)
    if "序号" in merged.columns:
        last = written(merged.drop("序号"), "deduped")
        unwritten(typed)
        merged = C.renumber(last, ["__src", "__seq"], "序号")
        unwritten(last)
    merged = C.fill_defaults(merged)
    stamps = (C.SOURCE_COLUMN, C.GENERATED_AT_COLUMN, C.SOURCE_DATE_COLUMN)
    newest = F.array_max(F.transform(F.array(F.lit(""), *[F.lit(n) for n in file_names]), S.file_date))
    stamped = merged.drop("__src", "__seq").withColumn(C.GENERATED_AT_COLUMN, F.lit(generated_at.strftime("%Y%m%d%H%M%S"))) \
        .withColumn(C.SOURCE_DATE_COLUMN, newest)
    return stamped.select(*sorted(stamped.columns, key=lambda c: stamps.index(c) if c in stamps else -1))


def standard_sheet(merged: DataFrame, prior_period, current_period) -> DataFrame:
    """Application year, two-period allocation, missing columns filled (0.0 if money-named
    else ''), ordered to the 78-column layout."""
    df = merged
    amount = F.col("产品金额") if "产品金额" in df.columns else F.lit(0.0)
    # the texts of the dates are stripped once, in a projection of their own
    texts = {"__y": "合同申请日期", "__s": "明细运维开始开始日期", "__e": "明细运维结束日期"}
    df = df.select("*", *[(strip_all(c) if c in merged.columns else F.lit(None).cast("string")).alias(n) for n, c in texts.items()],
                   amount.alias("__a"))
    df = df.withColumn("__s", stripped_date(F.col("__s"))).withColumn("__e", stripped_date(F.col("__e")))
    if "合同申请年份" not in merged.columns and "合同申请日期" in merged.columns:
        df = df.withColumn("合同申请年份", F.year(stripped_date(F.col("__y"))))
    df = allocation.add_allocation_columns(df, start="__s", end="__e", amount="__a", apply_year="合同申请年份",
                                           prior_period=prior_period, current_period=current_period)
    rename = dict(zip([c for _, c in L.ALLOCATION_LAYOUT], [h for h, _ in L.ALLOCATION_LAYOUT]))
    df = df.select(*[F.col(f"`{c}`").alias(rename.get(c, c)) for c in df.columns])
    headers = [h for h, _ in L.STANDARD_LAYOUT]
    return df.select(*[F.col(f"`{h}`") if h in df.columns else
                       (F.lit(0.0) if C.is_money_column(h) else F.lit("")).alias(h) for h in headers])


# Converter kinds per snapshot column (P14): int / date / decimal / create_date; others text.
INT_COLUMNS = ("seq_no", "free_ops_months", "detail_qty", "contract_days")
DATE_COLUMNS = ("contract_apply_date", "archive_date", "ops_start_date", "ops_end_date", "prev_year_period_start",
                "prev_year_period_end", "cur_year_period_start", "cur_year_period_end")
DECIMAL_COLUMNS = ("total_amount", "annual_ops_amount", "unit_price", "detail_amount_with_tax", "product_amount",
                   "cum_billing", "cum_collection", "cum_revenue", "cur_year_billing", "prev_year_billing",
                   "cur_year_collection", "prev_year_collection", "cur_year_revenue", "prev_year_revenue",
                   "cur_year_amort", "prev_year_amort", "prev_year_calc_amort", "prev_year_adjusted_amort",
                   "cur_year_calc_amort", "cur_year_adjusted_amort")


def typed_snapshot(sheet: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Header text -> snapshot columns with their converters (S7 + P14), absent columns NULL;
    the ``keep`` columns pass through."""
    # the cells are stripped once, in a projection of their own, as the converters look at their text several times
    cells, cols = [], []
    for h, c in L.STANDARD_LAYOUT:
        src = F.col(f"`{h}`") if h in sheet.columns else F.lit(None)
        cells.append((without_commas(src) if c in DECIMAL_COLUMNS else strip_all(src)).alias(f"__{c}"))
        text = F.col(f"__{c}")
        if c in INT_COLUMNS:
            e = stripped_int(text)
        elif c in DATE_COLUMNS:
            e = stripped_date(text)
        elif c in DECIMAL_COLUMNS:
            e = plain_number(text).cast("decimal(18,2)")
        elif c == "create_date":
            e = F.when(text != "", F.substring(text, 1, 8))
        else:
            e = F.when(text != "", text)
        cols.append(e.alias(c))
    return sheet.select(*cells, *keep).select(*cols, *keep)


def load_contract_snapshot(sheet: DataFrame, current: DataFrame, baseline: DataFrame, engineer_map: DataFrame,
                           baseline_date: str | None = None) -> dict[str, DataFrame]:
    """Layout check, typed conversion, required contract number, baseline platform,
    engineer by final platform, upsert on (contract, item, detail, date), counts.
    ``table`` holds the new content of the touched snapshot partitions only. Of lines with the same key
    the last one stands: by ``row_no`` when the sheet has it, else in reading order."""
    headers = [c for c in sheet.columns if c != "row_no"]
    L.check_layout(headers, ([h for h, _ in L.LEGACY_LAYOUT], [h for h, _ in L.STANDARD_LAYOUT]))
    place = F.col("row_no") if "row_no" in sheet.columns else F.monotonically_increasing_id()
    rows = typed_snapshot(sheet.withColumn("__o", place), keep=["__o"])
    skipped = rows.where(F.col("contract_id").isNull())
    rows = rows.where(F.col("contract_id").isNotNull())
    keys = ["contract_id", "item_code", "exec_detail_id"]
    rows = C.apply_baseline_platform(rows, baseline, keys, baseline_date=baseline_date)
    rows = C.apply_engineer_override(rows, engineer_map)
    # only the snapshot partitions this sheet touches are read and returned, to be written back with a
    # dynamic partition overwrite
    current = touched_partitions(current, rows, "create_date")
    merged = H.snapshot_upsert(current, rows.drop("reused_baseline", "mapped_engineer"),
                               keys + ["create_date"], "__o", [c for c in current.columns if c not in keys + ["create_date"]])
    outcomes = merged.where(F.col("outcome") != "kept").select("outcome", "create_date") \
        .unionByName(skipped.select(F.lit("skipped").alias("outcome"), "create_date"))
    counts = H.outcome_counts(outcomes, extra=[F.count_distinct("create_date").alias("snapshot_dates")])
    return {"table": merged.drop("outcome"), "counts": counts}


# -- G6 / G7 / G8 / G9 / G10 ----------------------------------------------------------------

def revenue_summary(raw_targets: DataFrame, snapshot: DataFrame, year: int, month: int,
                    snapshot_date: str | None = None, platforms: DataFrame | None = None) -> dict[str, DataFrame]:
    """Targets (checked), latest snapshot unless given, metrics, rows, total rows, unmapped. The lines have
    their platform, or the keys of the table ``platforms``."""
    targets = R.load_targets(raw_targets, year, month)
    snap = snapshot.where(F.col("create_date") == snapshot_date) if snapshot_date else S.latest_snapshot(snapshot)
    metrics = R.revenue_metrics(snap, year, month, platforms=platforms)
    rows = R.build_revenue_rows(targets, metrics, year, month)
    return {"summary": rows, "with_total": R.with_total_rows(rows), "unmapped": R.unmapped_platforms(metrics, targets)}


def time_metrics(tickets: DataFrame, attrs: DataFrame, metric_defs: Sequence[Mapping], overrides: DataFrame,
                 ticket_key: Sequence[str] = ("ticket_id",)) -> dict[str, DataFrame]:
    """Field look-up of the selected keys (S14), first values (W5), metric rows, status counts.
    The attributes are grouped per ticket before the one join with the tickets."""
    wide = W.field_columns(attrs, list(ticket_key), metric_defs)
    rows = W.metric_rows(tickets.join(wide, list(ticket_key), "left"), metric_defs, overrides)
    return {"rows": rows, "counts": W.status_counts(rows)}


def sample_details(tickets: DataFrame, strata: Sequence[str], id_col: str, n: int, seed: str = "0",
                   resolve_args: Mapping | None = None, labels: Mapping[str, str] | None = None,
                   report: str | None = None) -> dict[str, DataFrame]:
    """Counts per stratum and a repeatable sample of n per stratum; the sampled tickets resolved (G1) with
    ``resolve_args``, their columns named by the dictionary (P32) with ``labels``, and written as a JSON report (S15) to the
    folder ``report``, with nested columns as JSON text."""
    sample = S.stratified_sample(tickets, list(strata), id_col, n, seed)
    out = {"counts": S.counts_per(tickets, list(strata)), "sample": sample}
    if resolve_args is not None:
        details = resolve_tickets(sample.drop("sample_rank"), key=id_col, **resolve_args)
        nested = [c for c, kind in details.dtypes if kind.startswith(("array", "struct", "map"))]
        details = details.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in details.columns])
        out["details"] = label_columns(details, labels or {})
        if report is not None:
            write_json_report(out["details"], report)
    return out


def service_views(customer_history: DataFrame, contact_history: DataFrame, tickets: DataFrame,
                  customers: DataFrame, contacts: DataFrame) -> dict[str, DataFrame]:
    """Customer and contact service overviews (as-of joins) and the data-quality row."""
    return {
        "customer_overview": V.service_overview(customer_history, tickets, "customer_id", "company_id",
                                                ["customer_name", "customer_type", "province", "city",
                                                 "effective_from", "effective_to"]),
        "contact_overview": V.service_overview(contact_history, tickets, "contact_id", "cust_user_id",
                                               ["contact_name", "customer_id", "customer_name", "department_name",
                                                "position_name", "effective_from", "effective_to"],
                                               with_resolution=False),
        "quality": V.quality_counts(customers, contacts, tickets),
    }


def load_accounts(cells: DataFrame, names: Sequence[str], snapshot_date: str, money: Sequence[str] = (),
                  name_cols: Sequence[str] = ("customer_name", "customer_name2")) -> DataFrame:
    """G10 (accounts): by-position columns, money text parsed, rows without any customer name
    rejected, snapshot date stamped (to be written with a partition overwrite)."""
    rows = L.project_by_position(cells, "cells", names)
    rows = rows.select(*[parse_decimal_text(c).cast("decimal(18,2)").alias(c) if c in money
                         else blank_to_null(c).alias(c) for c in rows.columns])
    keep = F.lit(False)
    for c in name_cols:
        keep = keep | F.col(c).isNotNull()
    return H.append_snapshot(rows.where(keep), snapshot_date)


def load_personnel(rows: DataFrame, current: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """G10 (personnel): required headers, blank rows dropped, employee number as integer text,
    upsert by employee number; of rows with the same number the last one stands (``row_no`` when there
    is one, else reading order)."""
    src = L.require_columns(rows, list(headers))
    place = F.col("row_no") if "row_no" in src.columns else F.monotonically_increasing_id()
    typed = src.select(*[blank_to_null(F.col(f"`{h}`").cast("string")).alias(c) for h, c in headers.items()], place.alias("__o"))
    typed = typed.withColumn("employee_no", text_or_empty(F.regexp_replace("employee_no", r"^(-?\d+)\.0+$", "$1")))
    good = typed.where(F.col("employee_no") != "")
    return H.snapshot_upsert(current, good, ["employee_no"], "__o", [c for c in current.columns if c != "employee_no"])
