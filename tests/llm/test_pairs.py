"""N-gram join, line dedup and suffix dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from quaystone.llm import bytetext as bt
from quaystone.llm import line_dedup, ngram_join, suffix_dedup
from quaystone.llm.edit import distances, within
from quaystone.llm.families import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LINE_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def low(value):
    return -(1 << 63) if value is None else value


def brute_join(rows):
    sets = []
    for _, text in rows:
        words = WORDS.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    groups = Groups(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                groups.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        g = groups.find(i)
        least[g] = min(least.get(g, low(doc)), low(doc))
    return sorted((low(doc), len(s), least[groups.find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("which", ["docs", "edge_docs", "near_docs", "no_docs"])
def test_ngram_join(which, request):
    df = request.getfixturevalue(which)
    got = sorted((low(r.doc_id), r.n_shingles, low(r.component_id)) for r in ngram_join.ngram_join(df).collect())
    assert got == brute_join([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_large_family_in_blocks(near_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in near_docs.collect()]
    monkeypatch.setattr(ngram_join, "FAMILY_SHINGLES", 600)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(near_docs).collect())
    assert got == brute_join(rows)


def test_order_and_matches_change_only_the_work(near_docs, monkeypatch):
    """The first part of the order, the bound of counts and the number of matches don't change the links."""
    rows = [(r.doc_id, r.text) for r in near_docs.collect()]
    for sampled, most, cost in ((1, 5, 20.0), (0, 1 << 16, 20.0), (8, 1 << 16, 1000.0)):
        monkeypatch.setattr(ngram_join, "SAMPLED", sampled)
        monkeypatch.setattr(ngram_join, "MOST", most)
        monkeypatch.setattr(ngram_join, "VERIFY_COST", cost)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(near_docs).collect())
        assert got == brute_join(rows)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = (bytes(rng.integers(97, 100, rng.integers(0, 12)).tolist()) for _ in range(2))
        d = plain_distance(a, b)
        for limit in range(6):
            assert within(a, b, limit) == (d <= limit)
        if a:
            assert list(distances(a, b)) == [plain_distance(a, b[:k + 1]) for k in range(len(b))]


def brute_lines(rows, distance=3, similarity=0.9, min_words=5):
    places = []
    for k, (_, text) in enumerate(rows):
        for n, line in enumerate((text or "").split("\n")):
            words = LINE_WORDS.findall(line.translate(LOWER))
            if len(words) >= min_words:
                places.append((k, n, " ".join(words).encode()))
    forms = sorted({p[2] for p in places})

    def bits(word):
        data = np.frombuffer(word, np.uint8)
        value = bt.Rolling(data, bt.LOWER).of(np.array([0]), np.array([len(data)]))
        return np.unpackbits(value.view(np.uint8)).astype(int)

    sims = [2 * sum(bits(w) for w in f.split(b" ")) > len(f.split(b" ")) for f in forms]
    groups = Groups(len(forms))
    for i, a in enumerate(forms):
        for j in range(i):
            longer = max(len(a), len(forms[j]))
            if (sims[i] != sims[j]).sum() <= distance and abs(len(a) - len(forms[j])) <= 0.1 * longer + 1e-9:
                if plain_distance(a, forms[j]) <= int((1 - similarity) * longer + 1e-9):
                    groups.join(i, j)
    number, seen, drop = {f: k for k, f in enumerate(forms)}, set(), {}
    for k, n, form in places:
        g = groups.find(number[form])
        if g in seen:
            drop.setdefault(k, []).append(n)
        seen.add(g)
    return [(low(doc), tuple(drop.get(k, ())),
             "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in drop.get(k, ())))
            for k, (doc, text) in enumerate(rows)]


def test_keys_cut_into_blocks_link_alike(spark):
    """A hot key in small blocks gives the components that comparing all SimHashes gives."""
    rng = random.Random(3)
    base = rng.getrandbits(64)
    sims = [base ^ (1 << rng.randrange(24)) ^ (1 << rng.randrange(24)) ^ (1 << rng.randrange(24)) for _ in range(300)]
    sims = sorted({*sims, *(rng.getrandbits(64) for _ in range(200))})
    root = {x: x for x in sims}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(sims):
        for y in sims[:k]:
            if bin(x ^ y).count("1") <= 3:
                root[find(x)] = find(y)
    want = sorted(sorted(x for x in sims if find(x) == r) for r in {find(x) for x in sims})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in sims + sims[:50]], "sim long")
    for block in (40, 1 << 15):
        if block == 40:
            assert line_dedup._dealt_keys(df, 3, block).count() > 10 * len(sims)
        got = {}
        for r in components(line_dedup.sim_links(df, 3, block)).collect():
            got.setdefault(r.root, set()).add(r.id % (1 << 64))
        alone = [[x] for x in sims if not any(x in g for g in got.values())]
        assert sorted([sorted(g) for g in got.values()] + alone) == want



@pytest.mark.parametrize("which", ["docs", "edge_docs", "near_docs", "no_docs"])
def test_line_dedup(which, request):
    df = request.getfixturevalue(which)
    rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (low(r[0]), r[1] or ""))
    if which == "docs":
        rows = rows[:120]
        df = df.orderBy("doc_id").limit(120)
    done = line_dedup.dedup_lines(df).collect()
    assert sorted((low(r.row.doc_id), tuple(r.dropped), r.text) for r in done) == sorted(brute_lines(rows))
    if which == "edge_docs":
        assert set(done[0].row.asDict()) == set(df.columns)


def brute_suffix(rows, threshold=100):
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = set()
        for p in range(len(data) - threshold + 1):
            if data[p:p + threshold] in seen:
                gone.update(range(p, p + threshold))
            seen.add(data[p:p + threshold])
        kept = bytes(c for k, c in enumerate(data) if k not in gone)
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((low(doc), len(data), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("which", ["docs", "edge_docs", "near_docs", "no_docs"])
def test_suffix_dedup(which, request):
    df = request.getfixturevalue(which)
    rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (low(r[0]), r[1] or ""))
    done = suffix_dedup.suffix_dedup(df).collect()
    assert sorted((low(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                  for r in done) == brute_suffix(rows)


def test_suffix_dedup_periods(spark):
    """Texts that repeat themselves at short and long periods, and share parts with others."""
    unit = "abcdefg hijklmnop qrstuv "
    rows = [(1, unit * 12), (2, "Q" + unit * 5 + "R"), (3, "a" * 250), (4, "b" + "a" * 180),
            (5, unit * 3 + "z" * 101 + unit * 6), (6, ("x" * 99 + "y") * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    done = suffix_dedup.suffix_dedup(df).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                  for r in done) == brute_suffix(rows)
