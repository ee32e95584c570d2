"""Periodic runs, toxicity and spelling variants against brute force, held-out labels and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaystone.llm import periodic_runs, queries, spelling_variants, toxicity

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs --------------------------------------------------------------------------------------------------

def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def test_extensions():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(2, 120)
        values = np.array([rng.randrange(rng.choice([1, 2, 3])) for _ in range(n)])
        lce = periodic_runs.CoverLce(values)
        a = np.array([rng.randrange(n) for _ in range(80)])
        b = np.array([rng.randrange(n + 1) for _ in range(80)])
        a, b = a[a != b], b[a != b]
        want = [next(k for k in range(n + 1) if max(i, j) + k >= n or values[i + k] != values[j + k]) for i, j in zip(a, b)]
        assert lce.extension(a, b).tolist() == want


def test_runs_of_random_words():
    rng = random.Random(7)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 5)):
            n, k = rng.choice([0, 3, 6, 20, 60, 150]), rng.choice([1, 2, 3])
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 12)
                words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
            texts += [words] * rng.randint(1, 2)
        found = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64))
        for number, words in enumerate(texts):
            assert [(s, n, q) for t, s, n, q in zip(*found) if t == number] == brute_runs(words)


def test_grid_in_blocks(monkeypatch):
    words = np.array([0, 1, 2] * 200 + list(range(3, 50)) + [7] * 90)
    whole = [c.tolist() for c in periodic_runs.find_runs(words, np.array([len(words)]))]
    monkeypatch.setattr(periodic_runs, "POINTS", 50)
    assert [c.tolist() for c in periodic_runs.find_runs(words, np.array([len(words)]))] == whole == [[0, 0], [0, 647], [600, 90], [3, 1]]


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_periodic_runs(which, request):
    df = request.getfixturevalue(which)
    want = []
    for r in df.collect():
        words = WORDS.findall(r.text or "")
        runs = brute_runs(words)
        want.append((str(r.doc_id), len(words), tuple(runs), brute_collapsed(words, runs)))
    done = periodic_runs.periodic_runs(df).collect()
    assert sorted((str(r.doc_id), r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in done) == sorted(want)


def test_collapsed_text(spark):
    rows = [(1, "a b a b a b a b a c"), (2, "x  x\nx x x x y"), (3, "é é é é é é")]
    done = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.collapsed for r in done} == {1: "a b c", 2: "x y", 3: "é"}


def test_op11_contract(spark, docs):
    want = []
    for r in docs.collect():
        words = WORDS.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want.append((r.doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()))
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[1] for r in got)


# ---- spelling variants ----------------------------------------------------------------------------------------------

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(numbers, ratio=10):
    near = {w: [v for v in numbers if one_edit(w, v)] for w in numbers}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-numbers[v], v), default=None)
        form[w] = best if best is not None and numbers[best] >= ratio * numbers[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, n, len(near[w]), form[w] or "", numbers.get(form[w], 0), root(w)) for w, n in numbers.items())


def shown(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(11)
    numbers = Counter()
    for _ in range(60):
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(1, 12)))
        numbers[word] += 10 ** rng.randint(0, 6)
        for _ in range(rng.randint(0, 8)):
            k = rng.randrange(len(word))
            word = rng.choice([word[:k] + rng.choice("abñ") + word[k + rng.randint(0, 1):], word[:k] + word[k + 1:] or "a"])
            numbers[word] += 10 ** rng.randint(0, 6)
    return dict(numbers)


@pytest.mark.parametrize("most", [2048, 3])
def test_variants(spark, vocabulary, most, monkeypatch):
    """With a small bound all buckets are dealt anew by place."""
    monkeypatch.setattr(spelling_variants, "MOST", most)
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    assert shown(spelling_variants.group_variants(words)) == brute_variants(vocabulary)


def test_variants_in_blocks(vocabulary, monkeypatch):
    """Small blocks of pairs and of rows find the same pairs, each once."""
    words = sorted(vocabulary)
    rows = []
    for w in words:
        for longer in (len(w), len(w) + 1):
            for k in range(4):
                low, high = k * longer // 4, (k + 1) * longer // 4
                if high > low:
                    rows.append((hash((longer, low, high, w[:low], w[high - longer + len(w):])), w, longer, low, high))
    rows.sort()
    points, offsets = spelling_variants._code_points(pa.array([r[1] for r in rows]))
    columns = [np.array([r[k] for r in rows]) for k in (2, 3, 4, 0)]
    want = sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    for cells, matrix in ((1 << 23, 1 << 25), (40, 200)):
        monkeypatch.setattr(spelling_variants, "CELLS", cells)
        monkeypatch.setattr(spelling_variants, "MATRIX", matrix)
        i, j = spelling_variants.near_pairs(points, offsets, *columns)
        assert sorted(tuple(sorted((rows[a][1], rows[b][1]))) for a, b in zip(i, j)) == want


def test_variants_edge_cases(spark):
    rows = [(None, 3, "x"), ("", 4, "x"), ("word", None, None), ("wird", 5, "x"), ("wird", 5, "y"), ("z" * 5000, 2, ""),
            ("z" * 4999, 30, ""), ("\U0001F600ab", 1, ""), ("\U0001F601ab", 10, ""), ("ÿabc", 1, ""), ("abc", 7, ""), ("a", 1, "")]
    words = spark.createDataFrame(rows, "word string, n long, form string")
    numbers = Counter()
    for w, n, _ in rows:
        if w and n is not None:
            numbers[w] += n
    assert shown(spelling_variants.group_variants(words)) == brute_variants(dict(numbers))
    assert spelling_variants.group_variants(words.limit(0)).collect() == []


def test_chains(spark):
    numbers = {"aaaaaaaa"[:7 - k] + "b" * k: 11 ** (k + 1) for k in range(8)}
    words = spark.createDataFrame(list(numbers.items()), "word string, n long")
    got = shown(spelling_variants.group_variants(words))
    assert got == brute_variants(numbers) and {r[5] for r in got} == {"b" * 7}


def test_op13_contract(spark, docs):
    numbers = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                numbers[word] += 1
    assert shown(queries.op13_spelling_variants(spark, SF)) == brute_variants({w: n for w, n in numbers.items() if n >= 2})


# ---- toxicity -------------------------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_is_edit_distance():
    rng = random.Random(4)
    terms = ["abcab", "abcaacba", "bca", "éabcabc", "abcabc", "cabba"]
    automaton = toxicity.Automaton(terms)
    words = []
    for _ in range(600):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word) + 1)
            word[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "x", "é"])
        words.append("".join(word))
    got_term, got_edits = automaton.match(pa.array([w.encode() for w in words], pa.large_binary()))
    for word, term, edits in zip(words, got_term, got_edits):
        # the first letter stays: what follows it is within the edits
        fits = [(distance(word[1:], t[1:]), k) for k, t in enumerate(terms)
                if word[:1] == t[0] and distance(word[1:], t[1:]) <= toxicity.allowed(t)]
        assert (term, edits) == ((min(fits)[1], min(fits)[0]) if fits else (-1, 0)), word


def test_quotation():
    assert toxicity.is_quotation('He wrote "you ', '" and left')
    assert toxicity.is_quotation("the word ", " is an insult")
    assert not toxicity.is_quotation("what they said: you ", " go away")
    assert not toxicity.is_quotation('"said" he, you ', " there")
    assert not toxicity.is_quotation("", "")


def made_up(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    bad = ["blargon", "snivelwart", "drutz"]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = made_up(240, 1)
    return toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learns_terms_and_catches_misspellings(spark, learnt):
    assert {"blargon", "snivelwart", "drutz"} <= set(learnt.terms)
    texts = ["sune blargon and drutz you", "sune blargn and snivelwrat you", "they wrote \"blargon\" on it", "sune and you", None, ""]
    done = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), learnt)
    got = {r.doc_id: r for r in done.collect()}
    assert got[0].score >= 0.5 and got[1].score >= 0.5 and got[2].score < 0.5
    assert got[0].score > got[1].score > got[2].score > got[3].score == got[4].score == got[5].score
    assert [(h.word, h.term, h.edits, h.quoted, texts[1][h.start:h.end]) for h in got[1].hits] == [
        ("blargn", "blargon", 1, False, "blargn"), ("snivelwrat", "snivelwart", 2, False, "snivelwrat")]
    assert [h.quoted for h in got[2].hits] == [True]


def test_copies_teach_no_terms(spark):
    """A text copied many times has one neighbourhood a word."""
    rows, labels = made_up(80, 2)
    rows += [(1000 + k, "harmless sentence copied very often") for k in range(30)]
    labels += [(1000 + k, 1) for k in range(30)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not {"harmless", "sentence", "copied", "often"} & set(model.terms)


def test_toxicity_edge_cases(spark, edge_docs, no_docs, learnt):
    got = toxicity.score(edge_docs, learnt).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_docs, learnt).collect() == []
    labels = spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    model = toxicity.fit(edge_docs, labels)
    assert model.curve == toxicity.PRIOR and model.terms == toxicity.SEEDS
    assert toxicity.fit(no_docs, labels.limit(0)).curve == toxicity.PRIOR


def test_op12_held_out(spark):
    """Held-out rows of sf0.01: few toxic labels lack a toxic word, no clean document is taken for toxic."""
    done = queries.op12_toxicity(spark, SF.replace("0.001", "0.01"))
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").select("doc_id", "toxic")
    rows = done.join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 1
    english = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in english) >= len(english) / 2
    assert done.where("doc_id is not null").count() == spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet").count()
    assert done.select(F.max("score"), F.min("score")).first()[0] <= 1
