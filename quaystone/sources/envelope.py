"""API page bodies: JSON repair, envelope unwrap, declared counts, key profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.session import file_system

# Keys under which list payloads may sit, in priority order.
ENVELOPE_KEYS = ("data", "list", "items", "records", "rows", "companies", "users", "contacts", "contacters", "tickets")
DATA_KEYS = ("data", "list", "items", "records", "rows")
DECLARED_COUNT_KEYS = ("total", "count", "totalCount")

# An odd run of backslashes before a character that cannot follow one in JSON gets one more.
_BAD_ESCAPE = r'(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrtu])'


def repair_json_text(c) -> Column:
    """Double a lone backslash before a non-escape character ('C:\\dir' -> 'C:\\\\dir')."""
    return F.regexp_replace(c if isinstance(c, Column) else F.col(c), _BAD_ESCAPE, r"$1\\\\")


#: Follows a body when it is parsed.
_END = "#end of body"


def parse_body(df: DataFrame, body: str) -> DataFrame:
    """Body text -> VARIANT ``doc`` after repair; unparsable bodies give NULL ``doc``
    and can be split off as rejects with ``where(doc IS NULL)``. The parser stops at the end of a value, so the body is
    parsed as the first of two list elements: whatever follows the value makes it unparsable."""
    listed = F.try_parse_json(F.concat(F.lit("["), repair_json_text(body), F.lit(f',"{_END}"]')))
    whole = F.try_variant_get("__listed", "$[1]", "string") == _END
    return df.withColumn("__listed", listed).withColumn("doc", F.when(whole, F.try_variant_get("__listed", "$[0]", "variant"))) \
        .drop("__listed")


def _is_array(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def unwrap_items(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a page body (S1): a top-level list, else the first *list* under the envelope
    keys, else under ``data.<key>``; non-object items are dropped."""
    items = F.try_variant_get(_item_list(doc), "$", "array<variant>")
    ex = df.select(*keep, F.posexplode(items).alias("item_pos", "item"))
    return ex.where(F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False)))


def _item_list(doc: str) -> Column:
    """The list of a page body: itself, else under an envelope key, else under one within ``data``."""
    v = F.col(doc)
    cands = [v] + [F.try_variant_get(v, f"$.{k}", "variant") for k in ENVELOPE_KEYS] + \
        [F.try_variant_get(v, f"$.data.{k}", "variant") for k in DATA_KEYS]
    chosen = F.lit(None).cast("variant")
    for c in reversed(cands):
        chosen = F.when(_is_array(c), c).otherwise(chosen)
    return chosen


def reject_reason(body: str = "body", doc: str = "doc") -> Column:
    """Why a parsed body (:func:`parse_body`) has no rows to give: ``empty``, ``broken`` (no JSON after the repair), ``no_list``
    (JSON without a list of items), else NULL."""
    return (F.when(F.coalesce(F.trim(body), F.lit("")) == "", "empty").when(F.col(doc).isNull(), "broken")
            .when(_item_list(doc).isNull(), "no_list"))


def quarantine(bodies: DataFrame, path: str, batch: str, key: Sequence[str], body: str = "body") -> DataFrame:
    """Parse a batch of bodies (S2): returns the parsed good ones and writes the rejected ones, with key, body and reason, to the
    table at ``path``, partitioned by batch and reason. A batch that comes again replaces its own rejects."""
    parsed = parse_body(bodies, body).withColumn("reason", reject_reason(body))
    rejects = parsed.where("reason is not null").select(*key, body, F.lit(batch).alias("batch"), "reason")
    rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "reason").parquet(f"{path}/rejects")
    return parsed.where("reason is null").drop("reason")


def replay(spark: SparkSession, path: str, run: str, key: Sequence[str], mend, schema: str, body: str = "body") -> DataFrame:
    """Try the rejects of a quarantine again with their bodies mended (``mend``: Column -> Column); returns the rows that are good
    now, parsed, with their batch. Each moves on once: the keys of a run are written beside the rejects, and a later run
    leaves them out; the same ``run`` again gives the same rows. ``schema``: names and types of the key."""
    held = spark.read.schema(f"{schema}, {body} string, batch string, reason string").parquet(f"{path}/rejects")
    moved, fs_path = f"{path}/moved", file_system(spark, path)
    if fs_path[0].exists(fs_path[1](moved)):
        gone = spark.read.schema(f"{schema}, batch string, run string").parquet(moved).where(F.col("run") != run)
        held = held.join(gone.select("batch", *key), ["batch", *key], "left_anti")
    parsed = parse_body(held.withColumn(body, mend(F.col(body))), body)
    good = parsed.where(reject_reason(body).isNull())
    good.select(*key, "batch", F.lit(run).alias("run")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(moved)
    return good


def declared_count(doc: str = "doc") -> Column:
    """Declared total from total / count / totalCount (S3), under ``data`` first where that is an object."""
    at = [f"$.{p}{k}" for p in ("data.", "") for k in DECLARED_COUNT_KEYS]
    return F.coalesce(*[F.try_variant_get(F.col(doc), p, "bigint") for p in at])


def key_profile(df: DataFrame, json_col: str, by: Sequence[str]) -> DataFrame:
    """Sorted distinct top-level keys, row count and ok/empty status per group.

    Keys are exploded and de-duplicated per group before collecting, so a group holds at most
    its distinct keys (never one entry per row)."""
    keys = (df.select(*by, F.explode(F.json_object_keys(F.col(json_col))).alias("__key"))
            .distinct()
            .groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("__key")), ",").alias("keys")))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    out = counts.join(keys, list(by), "left").withColumn("keys", F.coalesce("keys", F.lit("")))
    return out.select(*by, "keys", "row_count",
                      F.when(F.col("row_count") > 0, "ok").otherwise("empty").alias("status"))
