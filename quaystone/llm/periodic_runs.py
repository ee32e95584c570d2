"""Periodic run detection: stretches of words that repeat with a period, found from longest common extensions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least
``max(LEAST_WORDS, LEAST_TIMES * q)`` that no neighbouring word extends keeping period q. A word is dropped from the
collapsed text if a run holds it after the run's first q words.

1. Words get exact numbers (a dictionary of their bytes), the texts of a chunk follow each other with a separator of
   their own, so that no extension crosses a text.
2. For each period q the grid q, 2q, 3q ... of a text is walked: a run of four periods covers three neighbouring grid
   points whose words are equal to those q later. The sum over q of n / q points is n log n.
3. Only texts with such a point get a :class:`CoverLce`, for the words and for the words in reverse. Its two answers at
   a grid point are the whole extent of the stretch with period q.
4. Stretches that several periods or points give are one run, that of the smallest period.

:class:`CoverLce` sorts only the suffixes that begin at places whose number modulo 13 is in the difference cover
{0, 1, 3, 9}. Any two places reach two sorted places by the same shift, of 12 words at most; those few words are compared,
and the rest is a range minimum over the common prefixes of sorted neighbours, from a sparse table.

A text is worked on in the task that holds its row; memory follows the longest text. Nothing is shuffled.

Defined cases: null, empty and blank texts have no words and no runs, and the collapsed text ""; equal rows give equal
rows; extra columns are left out unless named in ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import bounded_batches

#: Least length of a run, in words and in periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: A difference cover: every difference modulo MODULUS is one of two of its members.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Grid points that are looked at together.
POINTS = 1 << 21

#: The least shift that brings places i and j (modulo MODULUS) both into the cover.
_SHIFT = np.array([[next(d for d in range(MODULUS) if (i + d) % MODULUS in COVER and (j + d) % MODULUS in COVER)
                    for j in range(MODULUS)] for i in range(MODULUS)])

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class CoverLce:
    """Longest common extension of any two places of ``values`` (numbers of 0 or more)."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n = n
        self.values = np.concatenate([values.astype(np.int64), np.full(MODULUS, -1)])
        place = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        number = np.full(n + MODULUS, -1)
        number[place] = np.arange(len(place))
        # ranks of blocks of 1, 2, 4 ... times MODULUS words; rank 0 is past the end
        columns = [self.values[place + k] for k in reversed(range(MODULUS))]
        order = np.lexsort(columns)
        fresh = np.zeros(len(place), np.int64)
        for c in columns:
            fresh[1:] |= c[order][1:] != c[order][:-1]
        rank = np.empty(len(place), np.int64)
        rank[order] = np.cumsum(fresh) + 1
        levels = []
        while True:
            levels.append(np.concatenate([rank, [0]]))
            if len(place) == 0 or rank.max() == len(place):
                break
            step = MODULUS << (len(levels) - 1)
            later = np.where(place + step < n, number[np.minimum(place + step, n)], len(place))
            rank = np.unique(rank * (len(place) + 1) + levels[-1][later], return_inverse=True)[1].reshape(-1) + 1
        self.number, self.rank = number, rank - 1
        order = np.argsort(self.rank)
        self.table = [self._neighbours(place[order], levels, len(place))]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            half = 1 << (len(self.table) - 1)
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _neighbours(self, sorted_places: np.ndarray, levels: list[np.ndarray], past: int) -> np.ndarray:
        """Common words of each sorted suffix and the next one: whole blocks by rank, the last few words compared."""
        a, b = sorted_places[:-1].copy(), sorted_places[1:].copy()
        common = np.zeros(len(a), np.int64)
        at = lambda x: np.where(x < self.n, self.number[np.minimum(x, self.n)], past)
        for k in reversed(range(len(levels))):
            same = levels[k][at(a + common)] == levels[k][at(b + common)]
            same &= (a + common < self.n) & (b + common < self.n)
            common += np.where(same, MODULUS << k, 0)
        return common + self._compared(a + common, b + common, np.full(len(a), MODULUS))

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words of the places on, ``most`` at most."""
        got = np.zeros(len(a), np.int64)
        live = np.flatnonzero((most > 0) & (np.maximum(a, b) < self.n))
        while len(live):
            x, y = a[live] + got[live], b[live] + got[live]
            live = live[self.values[x] == self.values[y]]
            got[live] += 1
            live = live[(got[live] < most[live]) & (np.maximum(a[live], b[live]) + got[live] < self.n)]
        return got

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from places a and b on (a != b, each up to n)."""
        shift = _SHIFT[a % MODULUS, b % MODULUS]
        got = self._compared(a, b, shift)
        inside = np.flatnonzero((got == shift) & (np.maximum(a, b) + shift < self.n))
        if len(inside):
            x = self.rank[self.number[a[inside] + shift[inside]]]
            y = self.rank[self.number[b[inside] + shift[inside]]]
            low, width = np.minimum(x, y), np.abs(x - y)
            level = np.frexp(width.astype(np.float64))[1] - 1
            more = np.empty(len(inside), np.int64)
            for k in np.unique(level).tolist():
                of = np.flatnonzero(level == k)
                more[of] = np.minimum(self.table[k][low[of]], self.table[k][low[of] + width[of] - (1 << k)])
            got[inside] += more
        return got


def _grid(values: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, period) of the grid points that may lie in a run: four equal words a period apart."""
    periods = counts // LEAST_TIMES
    text = np.repeat(np.arange(len(counts)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (counts[text] - 1) // q - 2
    ends = np.cumsum(points)
    found = []
    low = 0
    while low < len(text):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + POINTS, "right")))
        item = np.repeat(np.arange(low, high), points[low:high])
        step = q[item]
        place = firsts[text[item]] + (np.arange(len(item)) + done - (ends - points)[item]) * step
        for k in range(LEAST_TIMES - 1):
            same = values[place + k * step] == values[place + (k + 1) * step]
            item, place, step = item[same], place[same], step[same]
        found.append((text[item], place, step))
        low = high
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number a word, equal exactly for words of equal bytes."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = np.ascontiguousarray(data[np.cumsum(inside[:-1], dtype=np.int8) > 0])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def find_runs(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period; ``values`` are the words of the texts, one
    after the other, ``counts`` the words of each text, starts count from each text's first word."""
    firsts = np.cumsum(counts) - counts
    text, place, q = _grid(values, firsts, counts)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    # the texts with a point, each followed by a separator that is found nowhere else
    used, at = np.unique(text, return_inverse=True)
    at = at.reshape(-1)
    lengths = counts[used] + 1
    base = np.cumsum(lengths) - lengths
    words = np.full(int(lengths.sum()), -1, np.int64)
    source = np.arange(len(words)) - np.repeat(base - firsts[used], lengths)
    inner = np.ones(len(words), bool)
    inner[base + lengths - 1] = False
    words[inner] = values[source[inner]]
    words[~inner] = (values.max() if len(values) else 0) + 1 + np.arange(len(used))
    there = place - firsts[text] + base[at]
    n = len(words)
    after = CoverLce(words).extension(there, there + q)
    before = CoverLce(words[::-1]).extension(n - there, n - there - q)
    start, end = there - before, there + q + after
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * q)
    at, start, end, q = at[long], start[long], end[long], q[long]
    order = np.lexsort((q, end, start))
    at, start, end, q = at[order], start[order], end[order], q[order]
    new = np.ones(len(at), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    at, start, end, q = at[new], start[new], end[new], q[new]
    order = np.lexsort((q, start))
    at, start, end, q = at[order], start[order], end[order], q[order]
    return used[at], start - base[at], end - start, q


def _collapsed(data: np.ndarray, row: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray,
               rows: int) -> pa.Array:
    """The kept words of each row, joined by one blank."""
    row, starts, ends = row[keep], starts[keep], ends[keep]
    size = ends - starts
    joined = np.zeros(len(row), np.int64)
    joined[1:] = row[1:] == row[:-1]
    offsets = np.concatenate([[0], np.cumsum(size + joined)])
    out = np.full(int(offsets[-1]), 32, np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letter = np.ones(len(out), bool)
    letter[offsets[:-1][joined > 0]] = False
    out[letter] = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    bounds = offsets[np.searchsorted(row, np.arange(rows + 1))]
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of docs (text and the columns ``keep``) with n_words, runs (by start and period) and collapsed."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").cast("string").alias("text"))
    schema = rows.select("kept").withColumn("n_words", F.lit(0).cast("long")).withColumn(
        "runs", F.lit(None).cast(RUNS)).withColumn("collapsed", F.lit("")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                n = high - low
                row, starts, ends = bt.words(data, offsets)
                counts = np.bincount(row, minlength=n)
                text, start, length, period = find_runs(word_numbers(data, starts, ends), counts)
                firsts = np.cumsum(counts) - counts
                again = np.zeros(len(row) + 1, np.int64)
                np.add.at(again, firsts[text] + start + period, 1)
                np.add.at(again, firsts[text] + start + length, -1)
                found = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)],
                                                   names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32)), found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, n), pa.array(counts.astype(np.int64)), lists,
                     _collapsed(data, row, starts, ends, np.cumsum(again[:-1]) == 0, n).cast(pa.string())],
                    names=["kept", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(work, schema).select("kept.*", "n_words", "runs", "collapsed")
