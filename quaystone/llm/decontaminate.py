"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit check.

Text is compared in lower case (A-Z) with blanks collapsed, as UTF-8 bytes. A document is contaminated by an item
if some window that begins at a word is within ``floor((1 - SIMILARITY) * length)`` edits of the item.

The CGK embedding walks along a string under a shared random bit for each (step, byte): emit the byte, then move
on or stay. Equal bits keep two strings in step, and after an edit the walks fall into step again, so a few
edits make few differences (Hamming distance). LSH samples positions of the embedding; a table is one walk with
``SAMPLED`` positions. An item is entered from its beginning and from a word at each of the ``PLACES`` on, so that the
tables see all of it, and a window that agrees from such a word on has its beginning looked for among the words about
so far before it. Walks are added until the recall measured on items of the whole class reaches ``TARGET_RECALL`` (or
``MAX_WALKS``) both for copies edited to the limit at random places and for copies with a word replaced, dropped or
put in at one place; an unedited copy is found by every table. Candidates are verified by exact edit distance, so
there are no false hits; of overlapping ones the one of fewest edits counts.

Windows are of the items' size by class (lengths within a factor of 1.3). Before the walk a window, with what lies
before it as far as the last of an item's places, must hold enough 8-byte grams of the items: d edits destroy 8 d of an
item's grams at most, so the bound is exact and drops no window within the limit.

The items are collected in blocks of ``BLOCK_ITEMS``, so a benchmark of any size costs memory for one block.

Defined cases: null, empty and blank texts hold nothing; items of fewer than ``SHORTEST`` normalised bytes are too
short to tell and aren't looked for; rows that repeat a doc_id each get a row; a null doc_id or item_id stays
null (as "null" among the items); other columns are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.edit import distances
from quaystone.llm.families import bounded_batches, id_of, key_of, rows_of

SIMILARITY = 0.93
TARGET_RECALL = 0.95
MAX_WALKS = 48
#: Positions sampled for a table, and tables of a walk.
SAMPLED, TABLES = 8, 48
#: Parts of an item from which on it is entered, at the next word, besides its beginning.
PLACES = (0.22, 0.44, 0.64)
GRAM = 8
SHORTEST = 30
BLOCK_ITEMS = 20000
#: Items whose edited copies measure the recall.
MEASURED_ITEMS = 100
_FILTER_BITS = 21

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FOLD[_BLANK] = 0x20


def limit_of(length: int) -> int:
    return int((1 - SIMILARITY) * length + 1e-9)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place of each byte in ``data``): lower case, blanks collapsed and none at a text's ends."""
    blank = _BLANK[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    begins = offsets[:-1][np.diff(offsets) > 0]
    keep[begins] = ~blank[begins]
    place = np.flatnonzero(keep)
    counts = np.concatenate([[0], np.cumsum(keep)])
    return _FOLD[data[place]], counts[offsets], place


def _grams(data: np.ndarray) -> np.ndarray:
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(data, GRAM).copy().view(np.uint64).ravel()


def _slot(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)


def word_starts(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts = np.ones(len(data), bool)
    starts[1:] = data[:-1] == 0x20
    return np.flatnonzero(starts & (data != 0x20))


def places_of(text: bytes) -> list[int]:
    """Where an item is entered from: its beginning and the first word at each of the places or beyond, if one begins
    before the next place."""
    begins, out = word_starts(text), [0]
    for part, after in zip(PLACES, (*PLACES[1:], 0.75)):
        k = np.searchsorted(begins, part * len(text))
        if k < len(begins) and begins[k] < after * len(text):
            out.append(int(begins[k]))
    return out


def _letters(rng, n: int) -> bytes:
    return bytes(rng.integers(97, 123, n).tolist())


def _edited_anywhere(rng, text: bytes) -> bytes:
    """A copy edited to the limit at random places."""
    new = bytearray(text)
    for _ in range(limit_of(len(text))):
        at, kind = int(rng.integers(len(new))), int(rng.integers(3))
        letter = int(rng.integers(97, 123))
        if kind == 0:
            new[at] = letter
        elif kind == 1:
            new.insert(at, letter)
        else:
            del new[at]
    return bytes(new)


def _edited_at_one_place(rng, text: bytes) -> bytes:
    """A copy with a word, or as much of it as the limit allows, replaced, dropped or put in."""
    limit, begins = limit_of(len(text)), word_starts(text)
    k, kind = int(rng.integers(len(begins))), int(rng.integers(3))
    start = int(begins[k])
    end = int(begins[k + 1]) if k + 1 < len(begins) else len(text)
    if kind == 0:
        n = min(limit, max(1, end - start - 1))
        return text[:start] + _letters(rng, n) + text[start + n:]
    if kind == 1:
        return text[:start] + text[min(end, start + limit):]
    return text[:start] + _letters(rng, max(1, min(limit - 1, int(rng.integers(2, 9))))) + b" " + text[start:]


class SizeClass:
    """Items of about one length with their tables."""

    def __init__(self, items: list[tuple[tuple[str, ...], bytes]], number: int):
        self.items, self.number = items, number
        lengths = [len(t) for _, t in items]
        self.shortest, self.longest = min(lengths), max(lengths)
        self.width = self.longest + limit_of(self.longest)
        self.least = min(n - GRAM + 1 - GRAM * limit_of(n) for n in lengths)
        self.steps = int(0.6 * self.shortest)  # early steps, where the walks of near strings have parted least
        self.walks: list[tuple[np.ndarray, np.ndarray]] = []  # bits (steps, 256), sampled steps (tables, sampled)
        self.keys: list[list[tuple[np.ndarray, np.ndarray]]] = []
        places = [places_of(t) for _, t in items]
        self.item = np.repeat(np.arange(len(items)), [len(p) for p in places])
        self.place = np.array([p for own in places for p in own])
        self.reach = int((self.place + np.array([limit_of(n) for n in lengths])[self.item]).max())
        own = self.padded([items[k][1][p:] for k, p in zip(self.item.tolist(), self.place.tolist())])
        measured = np.unique(np.linspace(0, len(items) - 1, min(len(items), MEASURED_ITEMS)).astype(np.int64)).tolist()
        turns = range(-(-MEASURED_ITEMS // len(measured)))
        rng = np.random.default_rng(1000 + self.number)
        kinds = [[(k, edit(rng, items[k][1])) for _ in turns for k in measured]
                 for edit in (_edited_anywhere, _edited_at_one_place)]
        found = [np.zeros(len(copies), bool) for copies in kinds]
        while len(self.walks) < MAX_WALKS and not (self.walks and min(f.mean() for f in found) >= TARGET_RECALL):
            self._add_walk()
            mine = self._table_keys(len(self.walks) - 1, own)
            for copies, hit in zip(kinds, found):
                self._find_copies(mine, copies, hit)
            self.keys.append([])
            for k in mine:
                order = np.argsort(k, kind="stable")
                self.keys[-1].append((k[order], order))
        self.recall = float(min(f.mean() for f in found))

    def padded(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), np.uint8)
        for k, t in enumerate(texts):
            out[k, :min(len(t), self.width)] = np.frombuffer(t[:self.width], np.uint8)
        return out

    def _find_copies(self, mine: np.ndarray, copies: list[tuple[int, bytes]], hit: np.ndarray) -> None:
        """Mark the copies (item, text) that the newest walk finds from the keys ``mine`` of the entries."""
        texts, entry, whose = [], [], []

        def look() -> None:
            if texts:
                theirs = self._table_keys(len(self.walks) - 1, self.padded(texts))
                hit[np.array(whose)[(mine[:, entry] == theirs).any(0)]] = True
                for held in (texts, entry, whose):
                    held.clear()

        for n in np.flatnonzero(~hit).tolist():
            k, text = copies[n]
            begins = word_starts(text)
            for e in np.flatnonzero(self.item == k).tolist():
                place = int(self.place[e])
                limit = limit_of(len(self.items[k][1])) if place else 0
                for start in begins[(begins >= place - limit) & (begins <= place + limit)].tolist():
                    texts.append(text[start:start + self.width])
                    entry.append(e)
                    whose.append(n)
            if len(texts) * self.width > 1 << 22:
                look()
        look()

    def _add_walk(self) -> None:
        rng = np.random.default_rng([len(self.walks), self.number, 99])
        steps = np.array([np.sort(rng.choice(self.steps, SAMPLED, replace=False)) for _ in range(TABLES)])
        self.walks.append((rng.integers(0, 2, (self.steps, 256), dtype=np.int32), steps))

    def _table_keys(self, walk: int, windows: np.ndarray) -> np.ndarray:
        """(tables, windows) keys of windows (windows, width)."""
        bits, sampled = self.walks[walk]
        wanted = {int(s) for s in sampled.ravel()}
        at, rows = np.zeros(len(windows), np.int32), np.arange(len(windows))
        seen = {}
        for step in range(max(wanted) + 1):
            letter = windows[rows, np.minimum(at, self.width - 1)]
            if step in wanted:
                seen[step] = letter.astype(np.int64)
            at = at + bits[step][letter]
        return np.array([sum(seen[int(s)] << (8 * k) for k, s in enumerate(table)) for table in sampled])

    def candidates(self, windows: np.ndarray) -> np.ndarray:
        """(window, entry, tables that agree) of windows (windows, width), sorted."""
        pairs = []
        for walk, tables in enumerate(self.keys):
            for keys, (known, entry) in zip(self._table_keys(walk, windows), tables):
                low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
                count = high - low
                window = np.repeat(np.arange(len(keys)), count)
                turn = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
                pairs.append(window * len(self.item) + entry[np.repeat(low, count) + turn])
        pair, times = np.unique(np.concatenate(pairs), return_counts=True)
        return np.stack([pair // len(self.item), pair % len(self.item), times], 1)


class Index:
    """Items by size class, and the filter of their grams. Items with equal texts are one entry with all their
    names, so that a text which many items share costs one comparison a window."""

    def __init__(self, items: list[tuple[str, str]]):
        column = pa.array([t for _, t in items], pa.string())
        data, offsets, _ = normalise(*bt.to_bytes(column))
        names: dict[bytes, set[str]] = {}
        for k, (name, _) in enumerate(items):
            text = data[offsets[k]:offsets[k + 1]].tobytes().rstrip(b" ")
            if len(text) >= SHORTEST:
                names.setdefault(text, set()).add(name)
        texts = sorted(((tuple(sorted(own)), text) for text, own in names.items()), key=lambda t: (len(t[1]), t))
        self.classes: list[SizeClass] = []
        filters = np.zeros(1 << _FILTER_BITS, np.uint64)  # a bit for each size class
        low = 0
        while low < len(texts):
            high = low
            while high < len(texts) and len(texts[high][1]) <= 1.3 * len(texts[low][1]):
                bit = np.uint64(1) << np.uint64(len(self.classes) % 64)
                filters[_slot(_grams(np.frombuffer(texts[high][1], np.uint8)))] |= bit
                high += 1
            self.classes.append(SizeClass(texts[low:high], len(self.classes)))
            low = high
        self.filter = filters.astype(np.uint8) if len(self.classes) <= 8 else filters

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str, int, int, int]]:
        """(row, item, start, end, edits) in normalised bytes; spans of one item don't overlap."""
        if not self.classes or len(data) < GRAM:
            return []
        flags = self.filter[_slot(_grams(data))]
        starts = np.ones(len(data), bool)
        starts[1:] = data[:-1] == 0x20
        starts[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(starts & (data != 0x20))
        row = bt.row_of(offsets, starts)
        ends = offsets[row + 1]
        padded = None
        found = []
        for size in self.classes:
            own = (flags & flags.dtype.type(1 << size.number % 64)) != 0
            inside = np.zeros(len(own) + 1, np.int32)
            np.cumsum(own, out=inside[1:])
            last = np.minimum(ends, starts + size.width) - GRAM + 1
            first = np.maximum(offsets[row], starts - size.reach)
            enough = inside[np.clip(last, 0, len(own))] - inside[np.minimum(first, len(own))]
            kept = np.flatnonzero(enough >= max(1, size.least))
            if not len(kept):
                continue
            if padded is None:
                padded = np.concatenate([data, np.zeros(max(c.width for c in self.classes), np.uint8)])
            for low in range(0, len(kept), 4096):
                some = kept[low:low + 4096]
                windows = padded[starts[some][:, None] + np.arange(size.width)]
                windows[starts[some][:, None] + np.arange(size.width) >= ends[some][:, None]] = 0
                agreed: dict[tuple[int, int], int] = {}
                for w, entry, times in size.candidates(windows).tolist():
                    item, place = int(size.item[entry]), int(size.place[entry])
                    begin, limit = int(starts[some[w]]) - place, limit_of(len(size.items[item][1])) if place else 0
                    # where the item would begin: a word of the same text
                    a = np.searchsorted(starts, max(begin - limit, int(offsets[row[some[w]]])), "left")
                    for k in range(int(a), int(np.searchsorted(starts, begin + limit, "right"))):
                        agreed[item, k] = agreed.get((item, k), 0) + times
                found += [(size, item, int(starts[k]), int(ends[k]), times) for (item, k), times in agreed.items()]
        return self._verified(data, offsets, found)

    @staticmethod
    def _verified(data: np.ndarray, offsets: np.ndarray, found: list) -> list[tuple[int, str, int, int, int]]:
        hits, taken, edited = [], {}, {}

        def covered(spans: list[tuple[int, int]], start: int, length: int) -> bool:
            return any(min(b, start + length) - max(a, start) > limit_of(length) for a, b in spans)

        for size, item, start, end, _ in sorted(found, key=lambda f: (-f[4], f[2], f[1])):
            names, text = size.items[item]
            row = int(bt.row_of(offsets, np.array([start]))[0])
            spans = taken.setdefault((row, text), [])
            if data[start:min(end, start + len(text))].tobytes() != text:
                edited.setdefault((row, text), {})[start] = names, end
            elif not covered(spans, start, len(text)):
                spans.append((start, start + len(text)))
                hits += [(row, name, start, start + len(text), 0) for name in names]
        for (row, text), begins in edited.items():
            spans, limit, near = taken[row, text], limit_of(len(text)), []
            for start, (names, end) in begins.items():
                if covered(spans, start, len(text)):
                    continue  # that span of this item again
                window = data[start:min(end, start + len(text) + limit)].tobytes()
                edits, length = min(((d, k) for k, d in enumerate(distances(text, window), 1)), default=(limit + 1, 0))
                if edits <= limit:
                    near.append((edits, start, length, names))
            for edits, start, length, names in sorted(near):
                if not covered(spans, start, len(text)):
                    spans.append((start, start + length))
                    hits += [(row, name, start, start + length, edits) for name in names]
        return sorted(hits)


def _collected(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about BLOCK_ITEMS."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [(r["item"], r["text"]) for r in part.collect()]


_HITS = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("edits", pa.int64())]))
_HITS_TYPE = "array<struct<item_id:string,start:bigint,end:bigint,edits:bigint>>"


def _spans_of(index: Index, column: pa.Array) -> list[list[dict]]:
    """Hits of each text, in code points of the text as it is."""
    out: list[list[dict]] = [[] for _ in range(len(column))]
    for low, _, data, offsets in bt.chunks(column):
        text, bounds, place = normalise(data, offsets)
        hits = index.hits(text, bounds)
        if hits:
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for row, item, start, end, edits in hits:
                first = points[offsets[row]]
                out[low + row].append({"item_id": item, "start": int(points[place[start]] - first),
                                       "end": int(points[place[end - 1] + 1] - first), "edits": edits})
    return out


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, hits) for each row of docs (doc_id, text): hits is an array of (item_id, start, end, edits) in code
    points, sorted by start, item and end; benchmark: item_id, text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text"),
                       F.array().cast(_HITS_TYPE).alias("hits"))
    for items in _collected(benchmark):
        shared = spark.sparkContext.broadcast(Index(items))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                more = _spans_of(shared.value, batch.column(1))
                old = batch.column(2).to_pylist()
                yield rows_of(doc=batch.column(0), text=batch.column(1),
                              hits=pa.array([a + b for a, b in zip(old, more)], _HITS))

        rows = rows.mapInArrow(work, f"doc long, text string, hits {_HITS_TYPE}")
    order = "array_sort(hits, (l, r) -> case when l.start < r.start then -1 when l.start > r.start then 1 " \
            "when l.item_id < r.item_id then -1 when l.item_id > r.item_id then 1 else 0 end)"
    return rows.select(id_of("doc").alias("doc_id"), F.expr(order).alias("hits"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    at = docs.columns.index("text")
    for items in _collected(benchmark):
        shared = spark.sparkContext.broadcast(Index(items))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not h for h in _spans_of(shared.value, batch.column(at))], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
