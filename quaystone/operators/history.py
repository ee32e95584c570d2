"""Change detection and history: row hash, SCD type 2, relation history, snapshot and ticket
upserts, incremental filter, outcome counts.

Parquet tables have no MERGE, so every upsert is a pure function
``(current, changes) -> new current`` (plus an outcome column); writing it back is a dynamic
partition overwrite of the touched partitions (see ``sources.sinks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.functions.dates import ntz_literal
from quaystone.functions.text import text_or_empty
from quaystone.operators.contracts import dedup_keep_last


def row_hash(columns: Sequence[str], timestamp_columns: Sequence[str] = ()) -> Column:
    """SHA-256 of the compact JSON of ``columns`` with sorted keys and NULLs kept.
    Timestamps render as 'yyyy-MM-dd HH:mm:ss', like a str() of a wall-clock datetime."""
    fields = []
    for c in sorted(columns):
        v = F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss") if c in timestamp_columns else F.col(c)
        fields.append(v.alias(c))
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


# -- SCD type 2 (M3, M4, W7, A7) -----------------------------------------------

HISTORY_META = ("version_no", "sync_batch_id", "effective_from", "effective_to", "is_current")


def max_version(history: DataFrame, key: str) -> DataFrame:
    """Max version per key (A7); keys without history are absent (read as 0)."""
    return history.groupBy(key).agg(F.max("version_no").alias("max_version"))


def empty_history(batch: DataFrame) -> DataFrame:
    """An empty history with the batch's columns plus the SCD2 columns."""
    return batch.limit(0).select(
        *batch.columns, F.lit(0).alias("version_no"), F.lit("").alias("sync_batch_id"),
        F.lit(None).cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(False).alias("is_current"))


def scd2_apply_batches(opened: DataFrame, batches: DataFrame, key: str, batch_no: str, batch_id: str, batch_time: str,
                       hash_col: str = "row_hash", closed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply any number of batches to the open versions of an SCD2 history in one pass.

    Stored and new rows meet in one window per key, in order of time and batch number, so the plan doesn't grow with the
    number of batches. A row opens a version where its hash differs from that of the row before it; the version number
    goes on from the stored one, and a version ends where the next begins. Closed versions aren't read: ``closed``
    (key, version_no, effective_from) is only needed for keys that may have closed versions and no open one.

    Replay guard, by key: a row whose time isn't later than the key's stored versions has been applied before and changes
    nothing; of rows of one key and one time the smallest batch number counts.
    Returns (the open versions and those that follow them, with effective_to and is_current; outcomes(key, ``batch_no``,
    outcome, replayed) with inserted / changed / unchanged / skipped)."""
    entity = [c for c in opened.columns if c not in HISTORY_META]
    meta = lambda version, batch, since, number, kind: [
        version.cast("int").alias("version_no"), batch.cast("string").alias("sync_batch_id"),
        since.cast("timestamp_ntz").alias("effective_from"), number.alias("__no"), F.lit(kind).alias("__kind")]
    no_number = F.lit(None).cast(batches.schema[batch_no].dataType)
    both = opened.select(*entity, *meta(F.col("version_no"), F.col("sync_batch_id"), F.col("effective_from"), no_number, 0))
    both = both.unionByName(batches.select(
        *entity, *meta(F.lit(None), F.col(batch_id), F.col(batch_time), F.col(batch_no), 1)))
    if closed is not None:
        both = both.unionByName(closed.select(
            key, *meta(F.col("version_no"), F.lit(None), F.col("effective_from"), no_number, -1)), allowMissingColumns=True)
    in_time = Window.partitionBy(key).orderBy("effective_from", "__kind", "__no", hash_col)
    whole = in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    new, stored = F.col("__kind") == 1, F.col("__kind") <= 0
    same_time = new & (F.lag("__kind").over(in_time) == 1) & (F.lag("effective_from").over(in_time) == F.col("effective_from"))
    seen = both.select(
        "*", F.max(F.when(stored, F.col("version_no"))).over(whole).alias("__last"),
        F.max(F.when(stored, F.col("effective_from"))).over(whole).alias("__since"),
        F.max(F.when(F.col("__kind") == 0, F.col(hash_col))).over(whole).alias("__open_hash"),
        F.coalesce(same_time, F.lit(False)).alias("__again"))
    replayed = new & (F.col("__again") | F.coalesce(F.col("effective_from") <= F.col("__since"), F.lit(False)))
    seen = seen.withColumn("replayed", replayed)
    live = F.when((F.col("__kind") >= 0) & ~F.col("replayed"), F.col(hash_col))
    before = F.last(live, ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, -1))
    seen = seen.withColumn("__before", before)
    outcome = (F.when(F.col("replayed"), F.when(F.col(hash_col) == F.col("__open_hash"), "unchanged").otherwise("skipped"))
               .when(F.col("__before").isNull(), "inserted").when(F.col("__before") == F.col(hash_col), "unchanged")
               .otherwise("changed"))
    seen = seen.withColumn("outcome", F.when(new, outcome))
    opens = F.coalesce(F.col("outcome").isin("inserted", "changed"), F.lit(False))
    number = F.coalesce("__last", F.lit(0)) + F.count_if(opens).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    seen = seen.withColumn("version_no", F.when(new, number).otherwise(F.col("version_no")).cast("int"))
    until = F.lead("effective_from").over(in_time)
    values = {"effective_to": until, "is_current": until.isNull()}
    versions = seen.where((F.col("__kind") == 0) | opens).select(
        *[values[c].alias(c) if c in values else F.col(c) for c in opened.columns])
    return versions, seen.where(new).select(key, F.col("__no").alias(batch_no), "outcome", "replayed")


def scd2_apply(history: DataFrame, batch: DataFrame, key: str, batch_id: str, batch_time,
               hash_col: str = "row_hash", guard: bool = False) -> tuple[DataFrame, DataFrame]:
    """Apply one batch (one row per key) to an SCD2 history (M3).

    Equal hash -> nothing changes; different hash -> the open version is closed at
    ``batch_time`` and version max+1 opens; unknown key, or one without an open version -> inserted.
    ``batch_time`` is passed in (never the wall clock), so replaying a batch is idempotent. Rows of keys that have a
    version of that time or a later one change nothing; with ``guard`` all of them are skipped, else those of another hash.
    Of closed versions only key, number and time are shuffled.
    Returns (new history, outcomes(key, outcome) with inserted/changed/unchanged/skipped)."""
    rows = batch.select("*", F.lit(1).alias("__batch"), F.lit(batch_id).alias("__id"), ntz_literal(batch_time).alias("__time"))
    closed = history.where(~F.col("is_current"))
    versions, done = scd2_apply_batches(history.where("is_current"), rows, key, "__batch", "__id", "__time", hash_col,
                                        closed.select(key, "version_no", "effective_from"))
    outcome = F.when(F.col("replayed"), "skipped").otherwise(F.col("outcome")) if guard else F.col("outcome")
    return closed.unionByName(versions), done.select(key, outcome.alias("outcome"))


def relation_rows(new_versions: DataFrame, key: str, link_cols: Sequence[str]) -> DataFrame:
    """Relation history projected from an entity history (M4): every version of the entity
    opens a link row carrying the linked ids, with the version's interval."""
    return new_versions.select(key, "version_no", *link_cols, *HISTORY_META[1:])


def scd2_from_batches(batches: DataFrame, key: str, batch_no: str, batch_id: str, batch_time: str,
                      hash_col: str = "row_hash") -> DataFrame:
    """History of many batches at once (closed form of repeated ``scd2_apply``): a version
    starts where the hash differs from the key's previous appearance; intervals by ``lead`` (W7)."""
    w = Window.partitionBy(key).orderBy(batch_no)
    versions = (batches.withColumn("__prev", F.lag(hash_col).over(w))
                .where(F.col("__prev").isNull() | (F.col("__prev") != F.col(hash_col))).drop("__prev"))
    return versions.select(
        *[c for c in batches.columns if c not in (batch_no, batch_id, batch_time)],
        F.row_number().over(w).cast("int").alias("version_no"),
        F.col(batch_id).alias("sync_batch_id"),
        F.col(batch_time).cast("timestamp_ntz").alias("effective_from"),
        F.lead(batch_time).over(w).cast("timestamp_ntz").alias("effective_to"),
        F.lead(batch_time).over(w).isNull().alias("is_current"))


# -- snapshot upsert (M1) ---------------------------------------------------------

def snapshot_upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order,
                    value_cols: Sequence[str]) -> DataFrame:
    """Upsert ``changes`` into ``current`` on ``keys`` (M1); last change per key wins.

    Keys are compared trimmed, here as in W1. A key with a NULL or blank part never collides (unique keys ignore
    it), so such change rows are always inserted and such stored rows kept. An updated row keeps its stored key columns.
    Returns the new table with ``outcome`` in inserted / updated / unchanged / kept."""
    cols = current.columns
    ch = dedup_keep_last(changes.select(*cols, order) if isinstance(order, str) else changes, keys, order) \
        .select(*cols)
    part = {k: F.nullif(text_or_empty(k), F.lit("")) for k in keys}
    whole = [part[k].isNotNull() for k in keys]
    complete = whole[0]
    for w in whole[1:]:
        complete = complete & w
    on = [f"__k{i}" for i in range(len(keys))]
    keyed = lambda df: df.where(complete).select(
        *[part[k].alias(n) for n, k in zip(on, keys)], F.struct(*cols).alias("__r"))
    j = keyed(ch).withColumnRenamed("__r", "__n").join(keyed(current).withColumnRenamed("__r", "__c"), on, "full_outer")
    new, old = F.col("__n").isNotNull(), F.col("__c").isNotNull()
    same = F.lit(True)
    for v in value_cols:
        same = same & F.col(f"__n.{v}").eqNullSafe(F.col(f"__c.{v}"))
    outcome = F.when(new & ~old, "inserted").when(~new, "kept").when(same, "unchanged").otherwise("updated")
    stored = set(keys)
    value = lambda c: F.when(old, F.col(f"__c.{c}")).otherwise(F.col(f"__n.{c}")) if c in stored \
        else F.when(new, F.col(f"__n.{c}")).otherwise(F.col(f"__c.{c}"))
    merged = j.select(*[value(c).alias(c) for c in cols], outcome.alias("outcome"))
    loose = ch.where(~complete).withColumn("outcome", F.lit("inserted"))
    return merged.unionByName(loose).unionByName(current.where(~complete).withColumn("outcome", F.lit("kept")))


def outcome_counts(outcomes: DataFrame, by: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """Counts per action and an overall status (A6): failed when nothing succeeded and
    something failed, partial when both, else success. ``changed`` (a new version) counts as updated."""
    agg = outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("outcome") == "inserted").alias("inserted"),
        F.count_if(F.col("outcome").isin("updated", "changed")).alias("updated"),
        F.count_if(F.col("outcome") == "unchanged").alias("unchanged"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"), *extra)
    ok = F.col("inserted") + F.col("updated") + F.col("unchanged") + F.col("skipped")
    status = F.when((F.col("failed") > 0) & (ok == 0), "failed").when(F.col("failed") > 0, "partial") \
        .otherwise("success")
    extra_names = [c for c in agg.columns if c not in by and c not in
                   ("rows", "inserted", "updated", "unchanged", "skipped", "failed")]
    base = [c for c in agg.columns if c not in extra_names]
    return agg.select(*base, status.alias("status"), *extra_names)


# -- incremental tickets (J9, M2) ---------------------------------------------------

def incremental_filter(incoming: DataFrame, stored: DataFrame, key: str, src_time: str,
                       stored_time: str = "source_updated_at", known: str | None = None) -> DataFrame:
    """Mark incoming rows to (re)load (J9): source time NULL, key absent, or times differ at
    second precision; others are ``skipped``. Adds ``action`` in load / skipped and, with ``known``,
    a boolean column of that name (the key is stored). A key stored with several create times counts
    once, with its newest source time."""
    s = stored.groupBy(F.col(key).alias("__k")).agg(F.max(stored_time).alias("__t"), F.lit(True).alias("__present"))
    j = incoming.join(s, incoming[key] == s["__k"], "left")
    u, t = F.date_trunc("second", F.col(src_time)), F.date_trunc("second", F.col("__t"))
    load = F.col(src_time).isNull() | F.col("__present").isNull() | F.col("__t").isNull() | (u != t)
    more = [] if known is None else [F.col("__present").isNotNull().alias(known)]
    return j.select(*incoming.columns, F.when(load, "load").otherwise("skipped").alias("action"), *more)


def ticket_upsert(main: DataFrame, child: DataFrame, new_main: DataFrame, new_child: DataFrame,
                  key: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Upsert the main rows and replace *all* child rows of every changed ticket (M2). ``key`` is the
    stored key, (ticket_id, create_dt) for tables that hold both; its parts are compared NULL-safely."""
    keys = [key] if isinstance(key, str) else list(key)
    ids = new_main.select(*[F.col(k).alias(f"__new_{k}") for k in keys]).distinct()

    def rest(df: DataFrame) -> DataFrame:
        same = [df[k].eqNullSafe(ids[f"__new_{k}"]) for k in keys]
        return df.join(ids, same, "left_anti")

    return (rest(main).unionByName(new_main.select(*main.columns)),
            rest(child).unionByName(new_child.select(*child.columns)))


# -- append snapshot (M5), empty-source guard (M9), run log rows (M8) ---------------------

def append_snapshot(rows: DataFrame, snapshot_date: str, date_col: str = "create_date") -> DataFrame:
    """Stamp a snapshot date on every row (M5). Written with a partition overwrite on
    ``date_col`` a re-import replaces that snapshot instead of duplicating it."""
    return rows.withColumn(date_col, F.lit(snapshot_date))


def guarded_batch_status(counts: DataFrame, source: str = "source", rows: str = "rows",
                         allow_empty: bool = False) -> DataFrame:
    """Per source: 'failed' (and nothing to write) when the source returned no rows, unless
    empty sources are allowed (M9)."""
    empty = F.coalesce(F.col(rows), F.lit(0)) == 0
    return counts.withColumn("status", F.when(empty & F.lit(not allow_empty), "failed").otherwise("success")) \
        .withColumn("write", ~(empty & F.lit(not allow_empty)))


def run_log_row(spark, task: str, batch_id: str, summary: DataFrame) -> DataFrame:
    """One run-log row (M8) from a one-row outcome summary (``outcome_counts``)."""
    return summary.select(F.lit(task).alias("task_name"), F.lit(batch_id).alias("sync_batch_id"), "*")
