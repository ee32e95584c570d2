"""Spelling variant grouping: words one edit apart are found by dense tiling of padded code-point matrices.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. That holds exactly when their
common prefix and their common suffix, counted apart, together reach the longer length minus one.

1. The longer word's places are cut into ``PARTS`` equal parts. The edit lies in one part, so the two words agree before
   it and behind it: each word is entered, for itself as the longer word and for a word one longer, under what it has
   before and behind each part. A bucket holds the words that agree so.
2. A bucket of more than ``MOST`` words is dealt anew by every single place of its part. Words that agree all around one
   place differ in that code point alone, so such a bucket is as large as the alphabet at most.
3. Buckets are dealt to tasks and sorted; a batch of rows becomes two matrices of code points, one padded behind, one
   written backwards, and whole blocks of pairs of a bucket are compared at once: the first column that differs gives
   the common prefix and the common suffix. A pair is counted only in the bucket of the smallest place that its edit can
   have, so no pair counts twice.
4. A task returns sums for the words of a batch, not pairs. A word's form is its near word of largest number (ties:
   smallest in code-point order) if that number is ``RATIO`` times its own or more. Numbers grow along forms, so the
   chains end; roots come by pointer doubling.

Defined cases: null and empty words and words without a number are left out; repeated words count as one, their numbers
added; extra columns are ignored; empty input gives an empty result; words of any length and any code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.llm.families import bounded_batches, scratch

#: Parts of a word; the rest is the key.
PARTS = 4
#: Most words of a bucket that are compared with each other.
MOST = 2048
#: How many times as frequent a form is.
RATIO = 10
#: Code points of the pairs compared together, and of the matrices of a block of rows.
CELLS, MATRIX = 1 << 23, 1 << 25

_ENTRY = "word string, n long, longer int, low int, high int, bucket long"


def words_of(docs: DataFrame, least: int = 1, *keep: str) -> DataFrame:
    """(keep, word) for each maximal run of Latin letters of ``least`` code points or more, A-Z in lower case."""
    low = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(low, F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
    return docs.select(*keep, F.explode(runs).alias("word"))


def _bucket(longer: Column, low: Column, high: Column) -> Column:
    """Hash of what a word has before and behind the places low to high of the longer word."""
    behind = high - (longer - F.char_length("word")) + 1
    return F.xxhash64(longer, low, high, F.substring("word", F.lit(1), low),
                      F.substring("word", behind, F.char_length("word")))


def _entries(words: DataFrame) -> DataFrame:
    """Each word under every part, for both lengths that the longer word may have."""
    size = F.char_length("word")
    longer = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"))
    part = longer.select("*", F.explode(F.array(*[F.lit(k) for k in range(PARTS)])).alias("part"))
    bound = lambda k: F.floor(k * F.col("longer") / F.lit(PARTS)).cast("int")
    cut = part.select("word", "n", "longer", bound(F.col("part")).alias("low"), bound(F.col("part") + 1).alias("high"))
    return cut.where("high > low").select("*", _bucket(F.col("longer"), F.col("low"), F.col("high")).alias("bucket"))


def _by_place(entries: DataFrame) -> DataFrame:
    """Entries under each single place of their part."""
    place = entries.select("word", "n", "longer", F.explode(F.sequence("low", F.col("high") - 1)).alias("low"))
    place = place.select("word", "n", "longer", "low", (F.col("low") + 1).alias("high"))
    return place.select("*", _bucket(F.col("longer"), F.col("low"), F.col("high")).alias("bucket"))


def _code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words plus one, offsets); one byte each where all are below 255."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(words.to_pylist())
    try:
        points = np.frombuffer(text.encode("latin-1"), np.uint8)
        if len(points) and points.max() == 255:
            points = points.astype(np.uint16)
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points + points.dtype.type(1), np.concatenate([[0], np.cumsum(sizes)])


def _matrices(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows padded with 0 behind, forwards and backwards."""
    column = np.arange(width)
    inside = column < sizes[:, None]
    ahead = np.where(inside, points[np.minimum(starts[:, None] + column, len(points) - 1)], 0)
    back = np.where(inside, points[np.maximum((starts + sizes)[:, None] - 1 - column, 0)], 0)
    return ahead.astype(points.dtype), back.astype(points.dtype)


def near_pairs(points: np.ndarray, offsets: np.ndarray, longer: np.ndarray, low: np.ndarray, high: np.ndarray,
               bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the near pairs of rows sorted by bucket, each pair once over all buckets."""
    n = len(bucket)
    sizes = np.diff(offsets)
    new = np.ones(n, bool)
    new[1:] = bucket[1:] != bucket[:-1]
    heads = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    end = np.concatenate([heads[1:], [n]])[number]
    out_i, out_j = [], []
    first = 0
    while first < len(heads):  # blocks of whole buckets whose matrices are of bounded size
        top = np.maximum.accumulate(longer[heads[first]:])
        reach = np.flatnonzero(top * np.arange(1, len(top) + 1) > MATRIX)
        stop = n if not len(reach) else heads[first] + int(reach[0])
        last = max(first + 1, int(np.searchsorted(heads, stop, "right")) - 1) if stop < n else len(heads)
        low_row, high_row = heads[first], n if last == len(heads) else heads[last]
        width = int(longer[low_row:high_row].max()) + 1
        ahead, back = _matrices(points, offsets[low_row:high_row], sizes[low_row:high_row], width)
        later = end[low_row:high_row] - np.arange(low_row, high_row) - 1
        done = np.concatenate([[0], np.cumsum(later)])
        pairs, row = max(1, CELLS // width), 0
        while row < high_row - low_row:
            upto = max(row + 1, int(np.searchsorted(done, done[row] + pairs, "right")) - 1)
            i = np.repeat(np.arange(row, upto), later[row:upto])
            j = i + 1 + np.arange(len(i)) - (done[i] - done[row])
            row = upto
            # a pair counts where its longer word is as long as the bucket says
            a, b = i + low_row, j + low_row
            fit = (np.maximum(sizes[a], sizes[b]) == longer[a]) & (longer[a] == longer[b]) & (low[a] == low[b])
            i, j, a, b = i[fit], j[fit], a[fit], b[fit]
            if not len(i):
                continue
            differ = ahead[i] != ahead[j]
            prefix = np.where(differ.any(1), differ.argmax(1), width)
            differ = back[i] != back[j]
            suffix = np.where(differ.any(1), differ.argmax(1), width)
            place = longer[a] - 1 - np.minimum(suffix, longer[a] - 1)
            near = (prefix + suffix >= longer[a] - 1) & (prefix < longer[a]) & (low[a] <= place) & (place < high[a])
            out_i.append(a[near])
            out_j.append(b[near])
        first = last
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def _sums(table: pa.Table) -> pa.RecordBatch | None:
    """(word, n_near, best) for the words of whole buckets that have near words there."""
    table = table.combine_chunks()
    bucket = table["bucket"].to_numpy()
    alone = np.ones(len(bucket), bool)
    same = bucket[1:] == bucket[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    table = table.filter(pa.array(~alone))
    if not table.num_rows:
        return None
    words, n = table["word"].combine_chunks(), table["n"].to_numpy()
    points, offsets = _code_points(words)
    longer, low, high, bucket = (table[c].to_numpy().astype(np.int64) for c in ("longer", "low", "high", "bucket"))
    i, j = near_pairs(points, offsets, longer, low, high, bucket)
    if not len(i):
        return None
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    # the best near word of a row: largest number, then first in code-point order, which is the order of the bytes
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(a[heads])), pa.array(np.diff(np.concatenate([heads, [len(a)]]))),
         pa.array(n[b[heads]]), words.take(pa.array(b[heads]))], names=["word", "n_near", "best_n", "best"])


def _compare(entries: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of each bucket, one row a word and batch of buckets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = table["bucket"].to_numpy()
            cut = int(np.argmax(last == last[-1]))  # the last bucket may go on in the next batch
            held = table.slice(cut)
            if cut and (done := _sums(table.slice(0, cut))) is not None:
                yield done
        if held is not None and (done := _sums(held)) is not None:
            yield done

    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(work, "word string, n_near long, best_n long, best string")


def near_sums(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n) that are distinct; a word may have several rows."""
    bounded_batches(words.sparkSession)
    entries = _entries(words)
    large = scratch(entries.groupBy("bucket").count().where(F.col("count") > MOST).select("bucket"), "large-buckets")
    if large.isEmpty():
        return _compare(entries)
    hot = _by_place(entries.join(large, "bucket", "left_semi"))
    return _compare(entries.join(large, "bucket", "left_anti").unionByName(hot))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): the end of each word's chain, by pointer doubling."""
    level = scratch(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = level.select(F.col("word").alias("root"), F.col("root").alias("later"))
        level = scratch(level.join(after, "root", "left").select(
            "word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")), "roots")
        if level.where("moved").isEmpty():
            return level.select("word", "root")
        level = level.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each distinct word of words (word, n)."""
    distinct = words.where("word <> ''").groupBy(F.col("word").cast("string").alias("word")).agg(
        F.sum("n").cast("long").alias("n")).where("n is not null")
    distinct = scratch(distinct, "words")
    nothing = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best")]
    found = near_sums(distinct).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    both = distinct.select("word", "n", *nothing).unionByName(found)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    summed = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    summed = scratch(summed.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"),
                                   F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    ends = roots(summed.where("form is not null"))
    return summed.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
