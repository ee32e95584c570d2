"""Writers: partition overwrite, JSON report, snapshot document, raw archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT_CATEGORY_HEADER = "文档类别"
DOCUMENT_CATEGORY_VALUE = "文档行"


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Write ``df`` replacing only the partitions it contains (S19, dynamic overwrite).
    Never read and overwrite the same path in one plan: write upserts to a staging path
    (or checkpoint) first."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def write_json_report(df: DataFrame, path: str) -> None:
    """JSON report sink (S15), UTF-8 lines."""
    df.write.mode("overwrite").json(path)


def document_rows(snapshot: DataFrame, order: Sequence[str], date_cols: Sequence[str]) -> DataFrame:
    """Snapshot document rows (S16): constant category column first, date columns as
    'yyyy-MM-dd' text where parsable (text outside years 1-9999 kept as is), ordered."""
    cols = [F.lit(DOCUMENT_CATEGORY_VALUE).alias(DOCUMENT_CATEGORY_HEADER)]
    for c in snapshot.columns:
        if c in date_cols:
            t = F.trim(F.col(c).cast("string"))
            parsed = F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd")), F.try_to_timestamp(t, F.lit("yyyyMMdd")),
                                F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")))
            cols.append(F.coalesce(F.when(F.year(parsed).between(1, 9999), F.date_format(parsed, "yyyy-MM-dd")), t).alias(c))
        else:
            cols.append(F.col(c))
    return snapshot.select(*cols).orderBy(*order)


def raw_archive(records: DataFrame, batch_id: str, entity_type: str, source_name: str, id_col: str | Column) -> DataFrame:
    """Raw payload rows (S17): one JSON payload per (batch, entity, source, id); replays
    of the same key collapse. Records without an id collapse only when their payloads are equal."""
    record_id = F.col(id_col) if isinstance(id_col, str) else id_col
    payload = F.to_json(F.struct(*[F.col(c) for c in records.columns]), {"ignoreNullFields": "false"})
    rows = records.select(F.lit(batch_id).alias("sync_batch_id"), F.lit(entity_type).alias("entity_type"),
                          F.lit(source_name).alias("source_name"), record_id.cast("string").alias("source_record_id"),
                          payload.alias("payload_json"))
    own = F.when(F.coalesce(F.trim("source_record_id"), F.lit("")) == "", F.col("payload_json"))
    return rows.withColumn("__own", own) \
        .dropDuplicates(["sync_batch_id", "entity_type", "source_name", "source_record_id", "__own"]).drop("__own")
