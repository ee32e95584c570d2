"""Shared steps of the operators that link rows: scratch tables, runs of equal keys in sorted partitions,
connected components, a membership filter of fixed size, and exact work inside components.

Nothing here brings links, components or fingerprints to the driver; the only collected data is the
filter's bit table, of ``FILTER_WORDS`` words at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.llm.bytetext import mix
from quaystone.session import written

#: Stands for a null id inside the operators.
NO_ID = -(1 << 63)
#: Words of 64 bits in a membership filter: 4 MB, whatever the input. A fuller filter passes more rows, never fewer.
FILTER_WORDS = 1 << 19
_SEEDS = (0x1B873593, 0x52DCE729, 0x38495AB5, 0x7FEB352D)


def key_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_of(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, so that a batch of long texts fits a Python worker, and of as many rows as that
    allows, so that batches of numbers are long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(1 << 16))


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder of ``spark.checkpoint.dir`` and read it back: cuts the lineage and
    outlives executors. The shuffles of the write are deleted as soon as it ends."""
    return written(df, f"llm/{name}")


def told_apart(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc, shown, text, more): ``shown`` is the doc_id, ``doc`` a key that no two rows share and that keeps the
    order of the doc_ids. Only where rows repeat a doc_id are they numbered, in the order of doc_id and text."""
    rows = docs.select(key_of().alias("doc"), key_of().alias("shown"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return rows
    return scratch(rows.orderBy("doc", "text").withColumn("doc", F.monotonically_increasing_id()), "numbered")


def rows_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()],
                                      names=list(columns))


def as_long(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def as_unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


# ---- runs of equal keys ---------------------------------------------------------------------------------------------

def hub_links(rows: DataFrame, key: str, node: str) -> DataFrame:
    """(a, b): each node of a key that two or more nodes share, with the key's first node.

    The rows are dealt by key and sorted on disk; a key's rows stream past, so one key of any length takes
    the memory of one batch, and it makes as many links as it has nodes.
    """
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = first = last_node = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same = np.empty(len(keys), bool)
            same[0] = last_key is not None and keys[0] == last_key
            same[1:] = keys[1:] == keys[:-1]
            starts = np.where(~same, np.arange(len(keys)), -1)
            np.maximum.accumulate(starts, out=starts)
            firsts = np.where(starts >= 0, nodes[starts], first if first is not None else 0)
            previous = np.concatenate([[last_node if last_node is not None else 0], nodes[:-1]])
            take = same & (nodes != previous) & (nodes != firsts)
            last_key, last_node, first = keys[-1], nodes[-1], firsts[-1]
            if take.any():
                yield rows_of(a=firsts[take], b=nodes[take])

    dealt = rows.select(F.col(key).alias("key"), F.col(node).alias("node"))
    dealt = dealt.repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(stream, "a long, b long")


# ---- connected components -------------------------------------------------------------------------------------------

#: Links that one task connects: 0.5 MB.
FEW_LINKS = 1 << 15


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of a few links (a, b)."""
    parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    ids, ends = np.unique(np.concatenate([np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])]),
                          return_inverse=True)
    a, b = ends.reshape(2, -1)
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    yield rows_of(id=ids, root=ids[root])


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of the links (a, b): ids have the same root exactly when links connect them.

    Each round moves every id to the neighbour (or itself) of the smallest hash and keeps the links between
    different targets, so the links shrink by a constant factor a round, on long chains too. A hub's links are
    pre-aggregated to one row a task, and joins on it are split by AQE. Once ``FEW_LINKS`` links are left at most, whatever
    there were, one task ends the work.
    """
    def ordered(a: str, b: str) -> DataFrame:
        return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")

    level = scratch(links.where("a != b").select(*ordered("a", "b")).distinct(), "links")
    steps, turn = [], 0
    while left := level.count():
        if left <= FEW_LINKS:
            steps.append(scratch(level.coalesce(1).mapInArrow(_joined, "id long, root long"), "step"))
            break
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.col(c), F.lit(t)).alias("h"), F.col(c).alias("v"))
        both = level.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
            level.select(F.col("b").alias("id"), F.col("a").alias("other")))
        nearest = both.groupBy("id").agg(F.min(rank("other")).alias("n"))
        step = scratch(nearest.select("id", F.least(F.col("n"), rank("id"))["v"].alias("root")), "step")
        steps.append(step)
        left = step.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        moved = level.join(left, "a").join(right, "b").where("ra != rb")
        level = scratch(moved.select(*ordered("ra", "rb")).distinct(), "links")
        turn += 1
    if not steps:
        return level.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = steps[0]
    for step in steps[1:]:
        after = step.select(F.col("id").alias("root"), F.col("root").alias("later"))
        out = out.join(after, "root", "left").select("id", F.coalesce("later", "root").alias("root"))
    return scratch(out, "roots")


# ---- membership filter ----------------------------------------------------------------------------------------------

def _bits(columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    key = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        key = mix(key ^ column.view(np.uint64))
    for seed in _SEEDS:
        h = mix(key ^ np.uint64(seed))
        yield (h >> np.uint64(6)) % np.uint64(FILTER_WORDS), np.uint64(1) << (h & np.uint64(63))


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bit table of the rows of keys (long columns): 4 MB at any input size, for :func:`passes`."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            for word, bit in _bits([c.to_numpy() for c in batch.columns]):
                np.bitwise_or.at(table, word, bit)
        used = np.flatnonzero(table)
        if len(used):
            yield rows_of(word=used, bits=as_long(table[used]))

    found = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(FILTER_WORDS, np.uint64)
    if found.num_rows:
        table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """True for every row of the table, and for a few others."""
    inside = np.ones(len(columns[0]), bool)
    for word, bit in _bits(list(columns)):
        inside &= (table[word] & bit) != 0
    return inside


# ---- exact work inside components -----------------------------------------------------------------------------------

def solve_families(members: DataFrame, weights: DataFrame, solve: Callable, cap: int) -> DataFrame:
    """(id, root) of the linked members; ``solve`` decides links exactly.

    members: family long, id long, size long, payload binary; weights: family, weight of each member. A family up to ``cap`` of weight is
    one group; a larger one is cut by hash into blocks of about ``cap``, and each pair of blocks is a group of
    its own, so a task holds two blocks at most and every pair of members meets in one. ``solve(sides, sizes,
    payloads)`` returns a root index for each member of the group; sides says the block (0 or 1), and with two
    different blocks only links between them are asked for. Groups emit at most one row a member; links across
    groups are united by :func:`components`.
    """
    totals = weights.groupBy("family").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n"))
    totals = totals.where("n > 1").select("family", F.ceil(F.col("total") / F.lit(cap)).cast("int").alias("k"))
    sized = members.join(totals, "family").withColumn("own", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    dealt = sized.select("family", "id", "size", "payload", "own", "k", other).select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "size", "payload",
        "own", F.col("k").alias("blocks"))
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "id")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            f, i, j = (batch.column(c).to_numpy() for c in range(3))
            change = np.flatnonzero((f[1:] != f[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *change.tolist(), len(f)]
            for low, high in zip(bounds, bounds[1:]):
                now = (f[low], i[low], j[low])
                if key is not None and now != key:
                    yield pa.Table.from_batches(held)
                    held = []
                key = now
                held.append(batch.slice(low, high - low))
        if held:
            yield pa.Table.from_batches(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, roots, split = [], [], []
        count = 0
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            i, j, blocks = group["i"][0].as_py(), group["j"][0].as_py(), group["blocks"][0].as_py()
            own = group["own"].to_numpy()
            sides = np.zeros(len(own), np.int8) if i == j else (own == j).astype(np.int8)
            root = solve(sides, group["size"].to_numpy(), group["payload"].to_pylist())
            names = group["id"].to_numpy()
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                ids.append(names[moved])
                roots.append(names[root[moved]])
                split.append(np.full(len(moved), blocks > 1))
                count += len(moved)
            if count > 20000:
                yield rows_of(id=np.concatenate(ids), root=np.concatenate(roots), split=np.concatenate(split))
                ids, roots, split, count = [], [], [], 0
        if ids:
            yield rows_of(id=np.concatenate(ids), root=np.concatenate(roots), split=np.concatenate(split))

    found = scratch(dealt.mapInArrow(work, "id long, root long, split boolean"), "solved")
    across = components(found.where("split").select(F.col("id").alias("a"), F.col("root").alias("b")))
    # a repeated input row may have come twice
    return found.where("not split").select("id", "root").distinct().unionByName(across)
