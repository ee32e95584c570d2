"""Toxicity: Levenshtein automata intersected with a lexicon trie, and windows that tell quotation from abuse.

Fit. Of the labelled rows (at most ``MAX_TRAINING``, those of smallest hash of doc_id) each word's toxic and clean
documents are counted, and its different neighbourhoods in toxic ones, so that copies of one text count once. Words with
enough neighbourhoods that are far more usual in toxic documents join the terms of ``SEEDS``; at most ``MAX_TERMS``.
Words that the automaton takes for misspellings but that clean labelled documents use are words of their own and are
remembered as such. A logistic curve over the evidence is fitted to the labels.

Automaton. The terms form a trie. Its product with the Levenshtein automaton of each term (no edit below ``ONE_EDIT``
letters, one from there, two from ``TWO_EDITS`` on; the first letter stays) is made deterministic: a state is the set of
trie nodes reached with their fewest edits. All distinct words of a batch run through its table at the same time.

Evidence. A hit counts its term's weight, times ``EDIT`` for each edit. The window around it, ``WINDOW`` characters on
each side, decides its context: between quotation marks or beside a word of reporting it is quotation, unless a word of
address is nearer. Abuse adds up; quotation adds less than half a hit, however much there is. The score is a logistic
curve of the evidence and of the evidence per hundred words, both as logarithms.

Defined cases: null, empty and blank texts have no hits and the score of no evidence; without labels of both classes the
curve is ``PRIOR``; rows that repeat a doc_id each get a row; labels other than 0 and 1 and null doc_ids are not learnt
from; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import bounded_batches, id_of, key_of, scratch

#: Most labelled rows that the fit reads, and most terms that it learns.
MAX_TRAINING, MAX_TERMS = 20000, 200
#: Fewest neighbourhoods in toxic documents and least ratio of the shares of toxic and clean documents of a learnt term.
LEAST_PLACES, LEAST_RATIO = 4, 15.0
#: Letters from which one and two edits are allowed, and what an edit leaves of a hit.
ONE_EDIT, TWO_EDITS, EDIT = 5, 8, 0.6
#: Characters of context on each side of a hit.
WINDOW = 80
#: Intercept and slopes of the curve where no labels tell, and how much they count as rows.
PRIOR, PRIOR_ROWS = (-3.0, 4.0, 2.0), 1.0
#: Texts of fewer words count as this long.
LEAST_WORDS = 50

# Abusive words in common use, and words of reporting and of address, in four languages.
SEEDS = ("idiot", "moron", "imbecile", "stupid", "scumbag", "worthless", "pathetic", "disgusting", "asshole", "bastard",
         "dumbass", "retard", "idiota", "imbécil", "estúpido", "gilipollas", "connard", "imbécile", "abruti",
         "dummkopf", "arschloch", "abschaum", "vollidiot")
REPORTING = ("said", "says", "called", "calls", "word", "words", "term", "quote", "quoted", "quotes", "insult", "means",
             "defined", "definition", "sagte", "nannte", "wort", "bedeutet", "dit", "appelé", "mot", "signifie", "dijo",
             "llamó", "palabra", "significa")
ADDRESS = ("you", "your", "yourself", "u", "ur", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "tú", "eres", "usted")

_PAIRS = [('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("»", "«"), ("‘", "’")]
_WORDS = re.compile(r"[^\W_]+")
#: Letters, digits and everything beyond ASCII.
_LETTERS = bt.spaces((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def allowed(term: str) -> int:
    """Edits that a misspelling of the term may have."""
    return 0 if len(term) < ONE_EDIT else 1 if len(term) < TWO_EDITS else 2


class Automaton:
    """Deterministic automaton of all words within the allowed edits of a term, as a table state x letter."""

    def __init__(self, terms: Sequence[str]):
        self.terms = list(terms)
        letters = sorted({c for t in self.terms for c in t})
        self.letter = {c: k + 1 for k, c in enumerate(letters)}  # 0: any other letter
        children, self._ends, self._most = [{}], [[]], [0]
        for number, term in enumerate(self.terms):
            node = 0
            path = [0]
            for c in term:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    self._ends.append([])
                    self._most.append(0)
                node = children[node][c]
                path.append(node)
            self._ends[node].append(number)
            for k in path:
                self._most[k] = max(self._most[k], allowed(term))
        self._children = children
        start = ((0, 0),)
        states, rows, todo = {(): 0, start: 1}, [[0] * (len(letters) + 1)], [start]
        accept = [(-1, 0), self._accepted(start)]
        while todo:
            state = todo.pop(0)
            row = []
            for c in [None, *letters]:
                after = self._step(state, c, first=state == start)
                if after not in states:
                    states[after] = len(states)
                    accept.append(self._accepted(after))
                    todo.append(after)
                row.append(states[after])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.term = np.array([t for t, _ in accept], np.int32)
        self.edits = np.array([e for _, e in accept], np.int8)

    def _step(self, state, c, first: bool):
        best: dict[int, int] = {}

        def reach(node: int, edits: int, skipped: bool = True) -> None:
            if edits > self._most[node] or edits >= best.get(node, 9):
                return
            best[node] = edits
            if skipped and node:
                for child in self._children[node].values():  # a letter of the term is missing in the word
                    reach(child, edits + 1)

        for node, edits in state:
            for letter, child in self._children[node].items():
                if letter == c:
                    reach(child, edits)
                elif not first:
                    reach(child, edits + 1)
            if not first:
                reach(node, edits + 1)
        return tuple(sorted(best.items()))

    def _accepted(self, state) -> tuple[int, int]:
        ends = [(edits, number) for node, edits in state for number in self._ends[node] if edits <= allowed(self.terms[number])]
        return (min(ends)[1], min(ends)[0]) if ends else (-1, 0)

    def match(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(term or -1, edits) of each word (lower case, as UTF-8 bytes)."""
        data, offsets = bt.to_bytes(words)
        text = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        top = max([ord(c) for c in self.letter], default=0) + 2
        classes = np.zeros(top, np.int32)
        for c, k in self.letter.items():
            classes[ord(c)] = k
        kind = classes[np.minimum(points, top - 1)]
        state = np.ones(len(words), np.int32)
        live, at = np.arange(len(words)), begins[:-1].copy()
        live = live[begins[1:] > begins[:-1]]
        while len(live):
            state[live] = self.table[state[live], kind[at[live]]]
            at[live] += 1
            live = live[(state[live] != 0) & (at[live] < begins[live + 1])]
        return self.term[state], self.edits[state]


def is_quotation(before: str, after: str) -> bool:
    """True if the text around a hit quotes it: marks around it or a word of reporting near, and no address nearer."""
    before, after = before.rsplit("\n", 1)[-1], after.split("\n", 1)[0]
    for left, right in _PAIRS:
        opened = before.count(left) % 2 == 1 if left == right else before.rfind(left) > before.rfind(right)
        if opened and right in after:
            return True
    left, right = _WORDS.findall(before.lower())[-4:][::-1], _WORDS.findall(after.lower())[:2]
    near = lambda words: min([k for side in (left, right) for k, w in enumerate(side) if w in words], default=9)
    return near(REPORTING) < near(ADDRESS)


@dataclass(frozen=True)
class Model:
    """Terms with their weights, words that are no misspellings, and the curve."""
    terms: tuple[str, ...] = SEEDS
    weights: tuple[float, ...] = (1.0,) * len(SEEDS)
    own: frozenset[str] = field(default_factory=frozenset)
    curve: tuple[float, float, float] = PRIOR


def _lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 in lower case, in UTF-8."""
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:][capital] += 32
    return data


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """(row, start, end, index, words): the words of a chunk in lower case, and the distinct ones."""
    row, starts, ends = bt.words(data, offsets, _LETTERS)
    letters = np.ascontiguousarray(_lower(data)[_LETTERS[data]])
    sizes = np.concatenate([[0], np.cumsum(ends - starts)])
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(letters)]).dictionary_encode()
    return row, starts, ends, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _hits(model: Model, automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """(row, start, end, word, term, edits, quoted) of a chunk, in order; start and end are bytes of the chunk."""
    row, starts, ends, index, words = _tokens(data, offsets)
    if not len(row):
        return
    term, edits = automaton.match(words)
    for k in np.flatnonzero(edits > 0):
        if words[int(k)].as_py().decode("utf-8", "replace") in model.own:
            term[k] = -1
    for k in np.flatnonzero(term[index] >= 0):
        r, s, e, w = int(row[k]), int(starts[k]), int(ends[k]), int(index[k])
        before = data[max(int(offsets[r]), s - WINDOW):s].tobytes().decode("utf-8", "ignore")
        after = data[e:min(int(offsets[r + 1]), e + WINDOW)].tobytes().decode("utf-8", "ignore")
        yield (r, s, e, words[w].as_py().decode("utf-8", "replace"), int(term[w]), int(edits[w]), is_quotation(before, after))


def evidence() -> tuple[Column, Column]:
    """What the hits of a text come to (abuse adds up, quotation stays below a half), whole and per hundred words."""
    whole = F.col("abuse") + F.lit(0.5) * F.col("quoted") / (1 + F.col("quoted"))
    return F.log1p(whole), F.log1p(100 * whole / F.greatest(F.col("n_words"), F.lit(LEAST_WORDS)))


def _training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc, toxic, text) of at most ``max_rows`` documents; of rows that repeat a doc_id the smallest text."""
    chosen = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc"), "doc").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc")  # max_rows pairs of numbers
    return met.groupBy("doc").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text"))


def _learnt_terms(rows: DataFrame, toxic: int, clean: int, max_terms: int) -> list[tuple[str, float]]:
    """(term, weight): words with many neighbourhoods that are far more usual in toxic documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy()
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                row, starts, ends, index, words = _tokens(data, offsets)
                if not len(row):
                    continue
                hashes = bt.Rolling(data).of(starts, ends)
                before, after = np.zeros((2, len(row)), np.uint64)  # 0 at the ends of a text
                same = row[1:] == row[:-1]
                before[1:], after[:-1] = np.where(same, hashes[:-1], 0), np.where(same, hashes[1:], 0)
                with np.errstate(over="ignore"):
                    place = bt.mix(before * np.uint64(3) + after)
                _, first = np.unique(row * len(words) + index, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [words.take(pa.array(index[first])).cast(pa.large_string()).cast(pa.string()),
                     pa.array(label[low + row[first]].astype(np.int32)), pa.array(place[first].view(np.int64))],
                    names=["word", "toxic", "place"])

    seen = rows.select("toxic", "text").mapInArrow(work, "word string, toxic int, place long")
    counts = seen.where("char_length(word) between 4 and 40").groupBy("word", "toxic", "place").count().groupBy("word").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("count"))), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("count"))), F.lit(0)).alias("clean"),
        F.count_if(F.col("toxic") == 1).alias("places"))
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    best = counts.where((F.col("places") >= LEAST_PLACES) & (F.col("places") * 2 > F.col("toxic")) & (ratio >= LEAST_RATIO))
    return [(r.word, min(1.0, float(np.log(r.ratio)) / 4.0)) for r in best.select("word", ratio.alias("ratio"), "places").orderBy(
        F.desc("places"), "word").limit(max_terms).collect()]


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Intercept and slopes by Newton steps, drawn to ``PRIOR`` as by PRIOR_ROWS rows."""
    if len(set(y.tolist())) < 2:
        return PRIOR
    w, prior = np.array(PRIOR), np.array(PRIOR)
    design = np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        slope = design.T @ (p - y) + PRIOR_ROWS * (w - prior)
        curve = (design * (p * (1 - p))[:, None]).T @ design + PRIOR_ROWS * np.eye(3)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, seeds: Sequence[str] = SEEDS, max_rows: int = MAX_TRAINING,
        max_terms: int = MAX_TERMS) -> Model:
    """Model of docs (doc_id, text) and labels (doc_id, toxic). The driver gets ``max_terms`` terms, the forms of the
    training rows that look like misspellings, and three numbers a training row."""
    bounded_batches(docs.sparkSession)
    rows = scratch(_training_rows(docs, labels, max_rows), "toxic-training")
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    weights = {t: 1.0 for t in seeds}
    if len(n) == 2:
        weights |= {t: max(w, weights.get(t, 0.0)) for t, w in _learnt_terms(rows, n[1], n[0], max_terms)}
    terms = tuple(weights)
    model = Model(terms, tuple(weights[t] for t in terms))
    shared = docs.sparkSession.sparkContext.broadcast((model, Automaton(terms)))

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy()
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                met = {(r, word) for r, _, _, word, _, edits, _ in _hits(*shared.value, data, offsets) if edits}
                if met:
                    yield pa.RecordBatch.from_arrays([pa.array([w for _, w in met]), pa.array([int(label[low + r]) for r, _ in met], pa.int32())],
                                                     names=["word", "toxic"])

    used = rows.select("toxic", "text").mapInArrow(forms, "word string, toxic int").groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
    usual = F.col("clean") / max(n.get(0, 0), 1) * 5 > F.col("toxic") / max(n.get(1, 0), 1)
    own = frozenset(r.word for r in used.where(usual).select("word").collect())
    model = Model(model.terms, model.weights, own)
    found = _scan(rows.select(F.col("doc").alias("doc_id"), "text", "toxic"), model, "toxic")
    whole, share = evidence()
    points = found.select(F.col("toxic").cast("double"), whole.alias("whole"), share.alias("share")).toPandas().to_numpy()
    return Model(model.terms, model.weights, own, _curve(points[:, 1:], points[:, 0]))


_HITS = "array<struct<start:bigint,end:bigint,word:string,term:string,edits:int,quoted:boolean>>"


def _scan(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """(doc, keep, n_words, abuse, quoted, hits): the hits of each row and what they weigh; start and end are code points."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model, Automaton(model.terms)))
    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text"), *keep)
    schema = rows.drop("text").withColumn("n_words", F.lit(0).cast("long")).withColumn("abuse", F.lit(0.0)).withColumn("quoted", F.lit(0.0)).withColumn(
        "hits", F.lit(None).cast(_HITS)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, automaton = shared.value
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("word", pa.string()), ("term", pa.string()),
                                   ("edits", pa.int32()), ("quoted", pa.bool_())]))
        for batch in batches:
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                weight, lists = np.zeros((2, high - low)), [[] for _ in range(high - low)]
                before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                for r, s, e, word, term, edits, quoted in _hits(known, automaton, data, offsets):
                    weight[int(quoted), r] += known.weights[term] * EDIT ** edits
                    base = int(before[offsets[r]])
                    lists[r].append({"start": int(before[s]) - base, "end": int(before[e]) - base, "word": word,
                                     "term": known.terms[term], "edits": edits, "quoted": quoted})
                rest = [batch.column(k).slice(low, high - low) for k in range(batch.num_columns) if k != 1]
                n_words = np.bincount(bt.words(data, offsets, _LETTERS)[0], minlength=high - low).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n_words), pa.array(weight[0]), pa.array(weight[1]), pa.array(lists, kind)],
                    names=["doc", *keep, "n_words", "abuse", "quoted", "hits"])

    return rows.mapInArrow(work, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, hits) for each row of docs (doc_id, text); score in 0 to 1."""
    whole, share = evidence()
    value = F.lit(model.curve[0]) + F.lit(model.curve[1]) * whole + F.lit(model.curve[2]) * share
    return _scan(docs, model).select(id_of("doc").alias("doc_id"), (1 / (1 + F.exp(-value))).alias("score"), "hits")
