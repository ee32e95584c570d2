"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct five-word shingles (64-bit hashes). Shingles have one global order: a fixed
part of them by hash (``SAMPLED`` eighths) comes first, by the number of sets that hold them, the rest follow by
hash. If two sets have a similarity of t or more, then for any number m of matches their first
``n - ceil(t n) + m`` shingles in this order have m in common. Each document takes the m of 1 to ``MAX_MATCHES``
with the least estimated cost (list entries plus candidates to verify, from the counts of its prefix), and a pair
is verified only if it shares the smaller of its two m. Verification intersects the whole sets.

The steps, all over whole texts:

1. one scan writes (doc_id, signature, size, number of shingles in the first part); documents with equal sets are
   one class from here on;
2. the shingles of the first part are dealt by shingle and stream past in sorted order, which counts the sets of
   each; only those in two or more sets come back to their sets. Most sets have enough shingles of their own to
   fill the prefix with them: they can't link with any other and are done;
3. the others choose m and their prefix (reading their text again if the first part is shorter than it), and its
   shingles are dealt again: each class is tied to the first class of the shingle, so a shingle of any frequency
   costs its length, never its square;
4. connected ties make families; every pair that can pass the prefix condition lies within one;
5. the sets of classes in families of two or more are read again (a fixed-size filter on doc_id keeps the
   others in the scan) and the join runs inside each family, in blocks where it is large; pairs already
   connected aren't verified again, so a group of near copies costs about its size;
6. a document's component is the smallest doc_id of the classes that links connect.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing, also not with each
other; with fewer than five words the whole sequence is the one shingle; rows that repeat a doc_id each get a
row; a null doc_id stays null and counts as smallest; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import (
    as_long,
    bounded_batches,
    components,
    hub_links,
    id_of,
    key_filter,
    key_of,
    passes,
    rows_of,
    scratch,
    solve_families,
)

#: Eighths of the shingles in the first part of the order.
SAMPLED = 3
#: Counts are told apart up to this number of sets.
MOST = 1 << 16
MAX_MATCHES = 4
#: Cost of verifying a candidate, in list entries.
VERIFY_COST = 20.0
#: Shingles of a block of a family: 16 MB.
FAMILY_SHINGLES = 1 << 21


def _sets(text: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for low, high, data, offsets in bt.chunks(text):
        row, start, end = bt.words(data, offsets)
        row, shingle = bt.shingles(row, bt.Rolling(data, bt.LOWER).of(start, end), high - low, words)
        yield low, high, row, shingle


def _first_part(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(61)) < np.uint64(SAMPLED)


def _shared(rows: DataFrame) -> DataFrame:
    """(sig, f, shingle) of the shingles that two or more sets hold, f the number of sets up to ``MOST``; rows:
    shingle, sig. A shingle's sets are held until their number is known or reaches ``MOST``."""
    def out(shingle, sig: np.ndarray, f) -> pa.RecordBatch:
        full = lambda v: np.ascontiguousarray(np.broadcast_to(np.asarray(v, np.int64), sig.shape))
        return rows_of(sig=sig, f=full(f), shingle=full(shingle))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None
        held: list[np.ndarray] = []  # sets of the shingle ``key``; none once they are too many to count
        many = False

        def add(part: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal held, many
            held.append(part)
            many = many or sum(map(len, held)) >= MOST
            if many:
                yield out(key, np.concatenate(held), MOST)
                held = []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, many
            n = sum(map(len, held))
            if n > 1:
                yield out(key, np.concatenate(held), n)
            held, many = [], False

        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, sig = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (shingle[1:] != shingle[:-1])
            new[0] = last != (shingle[0], sig[0])
            last = (shingle[-1], sig[-1])
            shingle, sig = shingle[new], sig[new]
            if not len(sig):
                continue
            cuts = np.flatnonzero(shingle[1:] != shingle[:-1]) + 1
            begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(sig)]])
            if shingle[0] == key:
                yield from add(sig[:end[0]])
                begin, end = begin[1:], end[1:]
            if len(begin):
                yield from close()
                f = np.repeat(end[:-1] - begin[:-1], end[:-1] - begin[:-1])
                take = begin[0] + np.flatnonzero(f > 1)
                if len(take):
                    yield out(shingle[take], sig[take], np.minimum(f[f > 1], MOST))
                key = shingle[-1]
                yield from add(sig[begin[-1]:])
        yield from close()

    dealt = rows.repartition("shingle").sortWithinPartitions("shingle", "sig")
    return dealt.mapInArrow(stream, "sig long, f long, shingle long")


def _choose(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Matches and prefix of each class (sig, doc, n, first, shared): shared are its (f, shingle) of the first part
    that other sets hold too; extra is the number of shingles that the prefix needs beyond the first part."""
    for batch in batches:
        out = {k: [] for k in ("sig", "doc", "n", "m", "extra", "prefix")}
        sig, doc, n, first = (batch.column(c).to_pylist() for c in range(4))
        shared = batch.column(4)
        for r in range(batch.num_rows):
            values = shared[r].values if shared[r].is_valid else None
            f = values.field("f").to_numpy() if values is not None else np.zeros(0, np.int64)
            token = values.field("shingle").to_numpy() if values is not None else f
            order = np.lexsort((token, f))
            f, token = f[order], token[order]
            partners = np.concatenate([[0], np.cumsum(f - 1)])
            need, own, best = -(-percent * n[r] // 100), first[r] - len(f), None
            for m in range(1, min(MAX_MATCHES, need) + 1):
                length = n[r] - need + m
                extra = max(0, length - first[r])
                known = min(len(f), max(0, length - own))
                cost = length + (partners[known] + extra) * (1 + VERIFY_COST / m)
                if best is None or cost < best[0]:
                    best = (cost, m, extra, known)
            _, m, extra, known = best
            if known or extra:
                for k, v in zip(out, (sig[r], doc[r], n[r], m, extra, token[:known])):
                    out[k].append(v)
        if out["sig"]:
            yield rows_of(**{k: pa.array(out[k], pa.int64()) for k in ("sig", "doc", "n", "m", "extra")},
                          prefix=pa.array(out["prefix"], pa.list_(pa.int64())))


def _signed(row: np.ndarray, shingle: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, sizes, signatures) of the sets of a chunk; a signature is the same for equal sets."""
    n = np.bincount(row, minlength=rows)
    bounds = np.concatenate([[0], np.cumsum(n)])
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(bt.mix(shingle), dtype=np.uint64)])
        return bounds, n, bt.mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64))


def _link(percent: int):
    """Joins the sets of one family; used by solve_families."""
    def solve(sides: np.ndarray, sizes: np.ndarray, payloads: list[bytes]) -> np.ndarray:
        raw = [np.frombuffer(p, np.uint64) for p in payloads]  # matches, prefix length, prefix, set
        matches, prefix = np.array([r[:2] for r in raw]).astype(np.int64).T
        sets = [r[2 + k:] for r, k in zip(raw, prefix)]
        n = np.array([len(s) for s in sets])
        bounds = np.concatenate([[0], np.cumsum(n)])
        vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
        token = np.searchsorted(vocabulary, np.concatenate([r[2:2 + k] for r, k in zip(raw, prefix)]))
        place = np.concatenate([[0], np.cumsum(prefix)])
        doc = np.repeat(np.arange(len(n)), prefix)
        order = np.argsort(token, kind="stable")
        posted = doc[order]
        begin = np.searchsorted(token[order], np.arange(len(vocabulary) + 1))
        label = np.arange(len(n))
        marked = np.zeros(len(vocabulary), bool)
        both = sides.any()
        for i in range(1, len(n)):
            entries = [posted[begin[t]:begin[t + 1]] for t in token[place[i]:place[i + 1]]]
            if not entries:
                continue
            shared = np.bincount(np.concatenate(entries), minlength=len(n))[:i]
            fit = (shared >= np.minimum(matches[i], matches[:i])) & (shared > 0)
            fit &= (100 * n[:i] >= percent * n[i]) & (100 * n[i] >= percent * n[:i])
            if both:
                fit &= sides[:i] != sides[i]
            left = np.flatnonzero(fit)
            left = left[label[left] != label[i]]
            if not len(left):
                continue
            left = left[np.argsort(-shared[left], kind="stable")]
            whole = flat[bounds[i]:bounds[i + 1]]
            marked[whole] = True
            while len(left):
                now, left = left[:32], left[32:]
                at = np.concatenate([np.arange(bounds[j], bounds[j + 1]) for j in now])
                cuts = np.concatenate([[0], np.cumsum(n[now])[:-1]])
                common = np.add.reduceat(marked[flat[at]].astype(np.int64), cuts)
                for j in now[(100 + percent) * common >= percent * (n[now] + n[i])]:
                    if label[j] != label[i]:
                        low, high = sorted((label[i], label[j]))
                        label[label == high] = low
                left = left[label[left] != label[i]]
            marked[whole] = False
        return label

    return solve


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text).

    Documents link when their shingle sets have a Jaccard similarity of ``percent`` / 100 or more; component_id
    is the smallest doc_id that links reach, the document's own included.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, row, shingle in _sets(batch.column(1), words):
                bounds, n, sig = _signed(row, shingle, high - low)
                first = np.bincount(row[_first_part(shingle)], minlength=high - low)
                yield rows_of(doc=batch.column(0).slice(low, high - low), sig=as_long(sig), n=n, first=first)

    def first_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, row, shingle in _sets(batch.column(0), words):
                _, _, sig = _signed(row, shingle, high - low)
                take = _first_part(shingle)
                yield rows_of(shingle=as_long(shingle[take]), sig=as_long(sig[row[take]]))

    table = scratch(source.mapInArrow(sizes, "doc long, sig long, n long, first long"), "sizes")
    classes = table.where("n > 0").groupBy("sig").agg(F.min("doc").alias("doc"), F.min("n").alias("n"),
                                                      F.min("first").alias("first"))
    shared = _shared(source.select("text").mapInArrow(first_parts, "shingle long, sig long"))
    shared = shared.groupBy("sig").agg(F.collect_list(F.struct("f", "shingle")).alias("shared"))
    # the prefix is longer than what a set has of its own in the first part
    open_ = classes.join(shared, "sig", "left").where(
        F.col("first") - F.greatest(F.size("shared"), F.lit(0)) < F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    chosen = scratch(open_.select("sig", "doc", "n", "first", "shared").mapInArrow(
        lambda batches: _choose(batches, percent),
        "sig long, doc long, n long, m long, extra long, prefix array<long>"), "chosen")
    longer = chosen.where("extra > 0").select("doc", "sig", "extra")
    short = spark.sparkContext.broadcast(key_filter(longer.select("doc")))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(short.value, batch.column(0).to_numpy())))
            for low, high, row, shingle in _sets(batch.column(1), words):
                _, _, sig = _signed(row, shingle, high - low)
                second = ~_first_part(shingle)
                values = np.split(as_long(shingle[second]), np.cumsum(
                    np.bincount(row[second], minlength=high - low))[:-1])
                yield rows_of(doc=batch.column(0).slice(low, high - low), sig=as_long(sig),
                              second=pa.array(values, pa.list_(pa.int64())))

    second = source.mapInArrow(rest, "doc long, sig long, second array<long>").join(longer, ["doc", "sig"])
    second = second.groupBy("sig").agg(F.first(F.slice("second", 1, F.col("extra").cast("int"))).alias("second"))
    prefixes = scratch(chosen.join(second, "sig", "left").select(
        "sig", "doc", "n", "m", F.concat("prefix", F.coalesce("second", F.array().cast("array<long>"))).alias("prefix")),
        "prefixes")
    posted = prefixes.select("sig", F.explode("prefix").alias("shingle"))
    families = components(hub_links(posted, "shingle", "sig")).select(F.col("id").alias("sig"),
                                                                       F.col("root").alias("family"))
    members = scratch(prefixes.join(families, "sig"), "members")
    wanted = spark.sparkContext.broadcast(key_filter(members.select("doc")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted.value, batch.column(0).to_numpy())))
            for low, high, row, shingle in _sets(batch.column(1), words):
                bounds, _, sig = _signed(row, shingle, high - low)
                whole = [shingle[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield rows_of(doc=batch.column(0).slice(low, high - low), sig=as_long(sig),
                              whole=pa.array(whole, pa.binary()))

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for m, prefix, whole in zip(batch.column(3).to_pylist(), batch.column(4), batch.column(5).to_pylist()):
                head = prefix.values.to_numpy()
                out.append(np.array([m, len(head)], np.int64).tobytes() + head.tobytes() + whole)
            yield rows_of(family=batch.column(0), id=batch.column(1), size=batch.column(2),
                          payload=pa.array(out, pa.binary()))

    read = source.mapInArrow(sets, "doc long, sig long, whole binary").join(members, ["doc", "sig"])
    read = read.select("family", "sig", "n", "m", "prefix", "whole").mapInArrow(
        payloads, "family long, id long, size long, payload binary")
    linked = solve_families(read, members.select("family", F.col("n").alias("weight")), _link(percent), FAMILY_SHINGLES)
    rooted = table.select("doc", "sig", "n").join(
        linked.select(F.col("id").alias("sig"), "root"), "sig", "left").select(
        "doc", "n", F.coalesce("root", "sig").alias("root"))
    smallest = rooted.where("n > 0").groupBy("root").agg(F.min("doc").alias("smallest"))
    out = rooted.join(smallest, "root", "left")
    return out.select(id_of("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, id_of("smallest")).otherwise(id_of("doc")).alias("component_id"))
