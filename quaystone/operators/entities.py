"""Canonical customer / contact rows from differently spelled source records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.functions.dates import entity_datetime
from quaystone.functions.text import blank_to_null, first_nonempty

# Candidate source names per canonical column, in priority order.
CUSTOMER_CANDIDATES = {
    "customer_id": ("uId", "uid", "id", "userId", "customerId", "companyId"),
    "customer_name": ("companyName", "customerName", "company_name", "name", "userName"),
    "customer_type": ("customerType", "customer_type", "rank", "type", "nature"),
    "province": ("province", "provinceName", "area", "areaName"),
    "city": ("city", "cityName", "area2", "area2Name"),
    "district": ("district", "districtName", "area3", "area3Name"),
    "address": ("address", "addr"),
    "contact_name": ("contactor", "contactName", "contact_name", "linkman"),
    "phone": ("mobile", "phone", "tel", "telephone"),
    "email": ("email", "mail"),
}
CONTACT_CANDIDATES = {
    "contact_id": ("cId", "cid", "id", "contactId", "contacterId"),
    "contact_name": ("realName", "name", "contactName", "contact_name"),
    "phone": ("mobile", "phoneNumber", "mobilePhone"),
    "fixed_phone": ("fixnumber", "fixedPhone", "tel", "phone"),
    "email": ("email", "mail"),
    "qq": ("QQ", "qq"),
    "wechat": ("wechat", "weChat", "wx"),
    "customer_id": ("companyId", "userId", "uId", "customerId"),
    "customer_name": ("companyName", "customerName", "customer_name"),
    "department_name": ("department", "departmentName", "deptName"),
    "position_name": ("position", "positionName", "jobTitle"),
}
UPDATED_AT_CANDIDATES = ("updateTime", "updateDT", "updated_at", "modifyTime")


def canonical_rows(records: DataFrame, candidates: dict, source_flag: str, tz: str = "Asia/Shanghai",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Canonical rows (P5/P6): each column = first non-blank candidate (names resolved exactly,
    then case-insensitively, against the schema), trimmed; plus source flag and update time.
    Adds ``rejected`` = the id (first column) is blank (P11). The ``keep`` columns pass through."""
    cols = [blank_to_null(first_nonempty(records, *cands)).alias(name) for name, cands in candidates.items()]
    upd = entity_datetime(first_nonempty(records, *UPDATED_AT_CANDIDATES), tz)
    out = records.select(*cols, F.lit(source_flag).alias("source_flags"), upd.alias("source_updated_at"), *keep)
    id_col = next(iter(candidates))
    return out.withColumn("rejected", F.col(id_col).isNull())
