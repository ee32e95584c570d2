"""Suffix-array dedup by a depth-limited radix sort: suffixes are ordered through the threshold only.

Every suffix that has ``threshold`` bytes left (a window) is sorted by most-significant-digit passes, and a
window leaves as soon as its group has one member or it is known to have an earlier equal. Groups that are
still equal at the full depth are exactly the repeated windows; all but each group's first are marked, and the
bytes they cover go.

Digits of the passes, from coarse to fine:

1. a window's smallest hash among its ``GRAM``-byte grams. Equal windows have equal digits, and neighbours
   mostly share theirs, so the pass sorts spans (maximal runs of windows with one digit), about 3 % of the
   suffixes;
2. within a digit, the bytes of the whole span: a span with an earlier equal span has all its windows
   repeated and leaves, a digit with one span leaves;
3. spans that differ within one digit are cut into their windows, sorted by the window's 64-bit hash
   within the digit (128 bits in all).

A span whose digit occurs more than once in it could hold equal windows itself, so it enters pass 1 window by
window, but at most the first two of equal windows of a text: the second shows that the text repeats itself, and
such a text's own later windows are found in the last step from its text alone. Rows are dealt by digit and sorted by Spark (on disk where needed), and the sorted rows stream past
with one row of state, so a digit of any frequency needs no memory. The text is shuffled once: both later uses
read the same exchange.

Defined cases: null text is empty; texts below the threshold keep all their bytes; rows that repeat a doc_id are
ordered by their text; a null doc_id comes first and stays null; other columns are ignored; an empty table gives
an empty result. What stays is bytes, as a cut may fall inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import as_long, bounded_batches, id_of, rows_of, told_apart

THRESHOLD = 100
GRAM = 32
#: A span's place: start byte times 2**24 plus its number of windows.
_SHIFT = 24


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, step, least = len(values) - width + 1, 1, values
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return np.minimum(least[:n], least[width - step:width - step + n])


def spans_of(data: np.ndarray, offsets: np.ndarray, threshold: int, gram: int):
    """(row, start, windows, digit, hash of the bytes) of the spans of a chunk."""
    none = np.zeros(0, np.int64)
    if len(data) < threshold:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    rolling = bt.Rolling(data)
    grams = rolling.windows(gram)
    width = threshold - gram + 1
    digit = _sliding_min(grams, width)
    n = len(digit)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    whole = np.arange(n) + threshold <= offsets[row + 1]
    new = np.ones(n + 1, bool)
    new[1:-1] = (digit[1:] != digit[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(whole & new[:-1])
    last = np.flatnonzero(whole & (new[1:] | np.concatenate([~whole[1:], [True]])))
    count = last - first + 1
    # where the digit occurs twice: leftmost place in the first window against rightmost in the last
    step = np.arange(width)
    twice = np.zeros(len(first), bool)
    for low in range(0, len(first), 1 << 14):
        part = slice(low, low + (1 << 14))
        goal = digit[first[part]][:, None]
        left = (grams[first[part][:, None] + step] == goal).argmax(1) + first[part]
        right = last[part] + width - 1 - (grams[last[part][:, None] + step[::-1]] == goal).argmax(1)
        twice[part] = left != right
    if twice.any():
        cut = np.repeat(twice, np.where(twice, count, 1))
        at = np.repeat(np.arange(len(first)), np.where(twice, count, 1))
        turn = np.arange(len(at)) - np.repeat(np.cumsum(np.where(twice, count, 1)) - np.where(twice, count, 1),
                                              np.where(twice, count, 1))
        first = first[at] + turn
        count = np.where(cut, 1, count[at])
        span = rolling.of(first, first + count - 1 + threshold)
        # of equal windows of a text the first two stay
        some = np.flatnonzero(cut)
        order = some[np.lexsort((first[some], span[some], row[first[some]]))]
        same = np.zeros(len(order), bool)
        same[2:] = (span[order[2:]] == span[order[:-2]]) & (row[first[order[2:]]] == row[first[order[:-2]]])
        keep = np.ones(len(first), bool)
        keep[order[same]] = False
        first, count = first[keep], count[keep]
    return row[first], first, count, digit[first], rolling.of(first, first + count - 1 + threshold)


def own_repeats(raw: np.ndarray, threshold: int) -> np.ndarray:
    """Starts of the windows of one text that equal an earlier window of it."""
    hashes = bt.Rolling(raw).windows(threshold)
    order = np.argsort(hashes, kind="stable")
    return order[1:][hashes[order[1:]] == hashes[order[:-1]]]


def _place(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << _SHIFT) | count


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans sorted by (digit, hash, doc, place) -> those that are repeated, and the first ones of digits with
    different spans, to be cut into windows."""
    last = held = None  # last row; the digit's first row while no other span of the digit has come
    for batch in batches:
        if not batch.num_rows:
            continue
        digit, span, doc, place = (batch.column(c).to_numpy() for c in range(4))
        if last is None:
            same_digit = np.concatenate([[False], digit[1:] == digit[:-1]])
            same_span = same_digit & np.concatenate([[False], span[1:] == span[:-1]])
        else:
            same_digit = np.concatenate([[last[0]], digit[:-1]]) == digit
            same_span = same_digit & (np.concatenate([[last[1]], span[:-1]]) == span)
        last = (digit[-1], span[-1])
        opens = ~same_digit
        other = same_digit & ~same_span  # a further span of the digit: it and the digit's first are cut
        cut = other.copy()
        starts = np.maximum.accumulate(np.where(opens, np.arange(len(digit)), -1))
        cut[starts[other & (starts >= 0)]] = True
        extra = held is not None and bool((other & (starts < 0)).any())
        take = np.flatnonzero(same_span | cut)
        out = [digit[take], doc[take], place[take], cut[take]]
        if extra:
            out = [np.concatenate([[v], o]) for v, o in zip((*held, True), out)]
        if extra or opens.any():
            held = None
        if opens.any():
            at = starts[-1]
            held = None if cut[at] else (digit[at], doc[at], place[at])
        if len(out[0]):
            yield rows_of(digit=out[0], doc=out[1], place=out[2], cut=out[3].astype(bool))


def _later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by (digit, hash, doc, start) -> all but the first of equal ones."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        digit, window, doc, start = (batch.column(c).to_numpy() for c in range(4))
        same = np.ones(len(digit), bool)
        same[1:] = (digit[1:] == digit[:-1]) & (window[1:] == window[:-1])
        same[0] = last is not None and last == (digit[0], window[0])
        last = (digit[-1], window[-1])
        if same.any():
            yield rows_of(doc=doc[same], place=_place(start[same], np.ones(int(same.sum()), np.int64)))


def suffix_dedup(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans) for each row of docs (doc_id, text): without every byte that lies in
    a ``threshold``-byte string which also starts earlier (smaller doc_id, or same document, earlier start)."""
    bounded_batches(docs.sparkSession)
    gram = min(GRAM, threshold)
    source = told_apart(docs)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for low, _, data, offsets in bt.chunks(batch.column(1)):
                row, start, count, digit, span = spans_of(data, offsets, threshold, gram)
                if len(row):
                    yield rows_of(digit=as_long(digit), span=as_long(span), doc=doc[low + row],
                                  place=_place(start - offsets[row], count))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digit, doc, begin = (batch.column(c).to_numpy() for c in range(3))
            for low, _, data, offsets in bt.chunks(batch.column(3)):
                hashes = bt.Rolling(data).windows(threshold)
                count = np.maximum(np.diff(offsets) - threshold + 1, 0)
                row = np.repeat(np.arange(len(count)), count)
                turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                yield rows_of(digit=digit[low + row], hash=as_long(hashes[offsets[row] + turn]), doc=doc[low + row],
                              start=begin[low + row] + turn)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits, docs_, starts, raws = [], [], [], []
            for r in range(batch.num_rows):
                raw, cuts = batch.column(2)[r].as_py().encode(), batch.column(3)[r].values
                place = cuts.field("place").to_numpy()
                start, count = place >> _SHIFT, place & ((1 << _SHIFT) - 1)
                digits.append(cuts.field("digit").to_numpy())
                docs_.append(np.full(len(place), batch.column(0)[r].as_py(), np.int64))
                starts.append(start)
                raws += [raw[a:b] for a, b in zip(start.tolist(), (start + count - 1 + threshold).tolist())]
            if raws:
                yield rows_of(digit=np.concatenate(digits), doc=np.concatenate(docs_), start=np.concatenate(starts),
                              raw=pa.array(raws, pa.binary()))

    found = source.select("doc", "text").where(F.octet_length("text") >= threshold).mapInArrow(
        spans, "digit long, span long, doc long, place long")
    settled = found.repartition("digit").sortWithinPartitions("digit", "span", "doc", "place").mapInArrow(
        _settle, "digit long, doc long, place long, cut boolean")
    lists = settled.groupBy("doc").agg(
        F.collect_list(F.when(~F.col("cut"), F.col("place"))).alias("gone"),
        F.collect_list(F.when(F.col("cut"), F.struct("digit", "place"))).alias("cuts"))
    texts = source.repartition("doc")
    # all columns of the texts, so that both uses read one exchange
    marked = texts.join(lists, "doc").where(F.size("cuts") > 0).select("doc", "shown", "text", "cuts",
                                                                      F.size("gone").alias("n_gone"))
    pieces_ = marked.mapInArrow(pieces, "digit long, doc long, start long, raw binary")
    repeated = pieces_.repartition("digit").mapInArrow(windows, "digit long, hash long, doc long, start long")
    repeated = repeated.sortWithinPartitions("digit", "hash", "doc", "start").mapInArrow(
        _later_windows, "doc long, place long")
    more = repeated.groupBy("doc").agg(F.collect_list("place").alias("more"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gone, more = batch.column(2), batch.column(3), batch.column(4)
            kept, n, removed, runs = [], [], [], []
            for r in range(batch.num_rows):
                raw = np.frombuffer(text[r].as_py().encode(), np.uint8)
                places = [c[r].values.to_numpy() for c in (gone, more) if c[r].is_valid and len(c[r].values)]
                if places:
                    places = np.concatenate(places)
                    start, count = places >> _SHIFT, places & ((1 << _SHIFT) - 1)
                    if (count == 1).any():  # it may repeat itself
                        own = own_repeats(raw, threshold)
                        start, count = np.concatenate([start, own]), np.concatenate([count, np.ones(len(own), np.int64)])
                    cover = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + count - 1 + threshold, -1)
                    inside = np.cumsum(cover[:-1]) > 0
                    removed.append(int(inside.sum()))
                    runs.append(int((inside & ~np.concatenate([[False], inside[:-1]])).sum()))
                    kept.append(raw[~inside].tobytes())
                else:
                    removed.append(0)
                    runs.append(0)
                    kept.append(raw.tobytes())
                n.append(len(raw))
            yield rows_of(shown=batch.column(1), kept=pa.array(kept, pa.binary()), n=pa.array(n, pa.int64()),
                          removed=pa.array(removed, pa.int64()), runs=pa.array(runs, pa.int64()))

    # the lists whole, as above, so that their exchange is read again
    last = texts.join(lists, "doc", "left").join(more, "doc", "left").select(
        "doc", "shown", "text", "gone", "more", F.size("cuts").alias("n_cuts"))
    out = last.mapInArrow(keep, "shown long, kept binary, n long, removed long, runs long")
    return out.select(id_of("shown").alias("doc_id"), F.col("kept"), F.col("n").alias("n_bytes"),
                      F.col("removed").alias("n_removed"), F.col("runs").alias("n_spans"))
