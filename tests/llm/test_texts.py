"""License scan, classifier, chat format, decontamination, personal data, rules, mixing and the pipeline."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quaystone.llm import (
    chat_format,
    decontaminate,
    license_scan,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    queries,
)

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_license(text):
    words = WORDS.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


@pytest.mark.parametrize("which", ["docs", "edge_docs", "no_docs"])
def test_license_base(which, request):
    df = request.getfixturevalue(which)
    want = sorted((str(r.doc_id), *map(str, brute_license(r.text))) for r in df.collect())
    done = license_scan.license_scan(df).collect()
    assert sorted((str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)))
                  for r in done) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in done)


def test_automaton_statistics():
    rng = random.Random(2)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 9))] for _ in range(3)]
        parts = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        automaton = license_scan.Automaton(sequences)
        tokens = [rng.randrange(4) for _ in range(30)]
        got = [n for _, n in automaton.statistics(tokens)]
        want = [max((n for n in range(k + 2) if n and tuple(tokens[k + 1 - n:k + 1]) in parts), default=0)
                for k in range(len(tokens))]
        assert got == want
        for state, n in automaton.statistics(tokens):
            for number, end in automaton.ends[state]:
                assert n <= end


def test_license_templates(spark):
    mit, bsd = (license_scan.TEMPLATES[k].split() for k in ("mit", "bsd"))
    rows = [(1, "Copyright x. " + " ".join(mit)), (2, " ".join(mit[:20] + ["changed"] + mit[21:])),
            (3, " ".join(bsd[:8])), (4, "the and of software in the")]
    done = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert done[1].labels == "mit" and done[1].score == 1.0 and done[1].spans == f"mit:2:{2 + len(mit)}"
    assert done[2].labels == "mit" and 0.9 < done[2].score < 1
    assert done[3].labels == "" and 0 < done[3].score < 0.6
    assert done[4].labels == ""


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_classifier.fit(docs, labels.where(~queries.held_out(F.col("doc_id"))))
    scored = quality_classifier.score(docs, model).join(labels, "doc_id").where(queries.held_out(F.col("doc_id"))).collect()
    right = [(r.score >= 0.5) == (r.quality == 1) for r in scored]
    assert len(right) > 1000 and sum(right) / len(right) > 0.98
    bad = [(r.score < 0.5) for r in scored if r.quality == 0]
    assert sum(bad) / len(bad) > 0.95


def test_classifier_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(14)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality_classifier.fit(edge_docs, labels)
    scores = quality_classifier.score(edge_docs, model).collect()
    assert len(scores) == edge_docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality_classifier.fit(edge_docs, labels.where("quality = 1")) is None
    assert {r.score for r in quality_classifier.score(edge_docs, None).collect()} == {0.5}
    kept = quality_classifier.keep_good(edge_docs, None)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert quality_classifier.score(no_docs, model).count() == 0


HARD = ["", " ", "\\", "\\\\", "a\\", "</s>", " </s>", "[/INST]", "x [/INST", "<<SYS>>\n", "\n<</SYS>>\n\n", "<|end|>", "|>", "<",
        "<|a|>b<|end|>", "\\</s>", "\n", "</s>[INST] ok [/INST]", "é\u2028\x00", "\\[INST]", "[INST", "<s>[INST] "]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "<|x|>", "a|>b", "\\"])
def test_chat_round_trip(role):
    parser, turns, whole = chat_format.Parser(), [], ""
    for text in HARD:
        piece, begin, end, _ = chat_format.render_turn(role, text)
        assert chat_format.unescape(piece[begin:end]) == text
        whole += piece
    for k in range(0, len(whole), 3):  # in pieces that cut through marks
        turns += parser.feed(whole[k:k + 3])
    assert turns == [(role, t) for t in HARD] and parser.rest == ""


def test_chat_edges(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "x"]), rng.choice([*HARD, None]), "extra")
            for c in (1, 2, None) for t in (0, 1, 1, 2, None)] + [(4, 0, "user", "only", "extra")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turn_no string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.chat_format(df)).collect()}
    order = lambda v: (v is not None, v if v is not None else 0)
    for conv in (1, 2, None, 4):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (order(r[1]), order(r[2]) if r[2] else (r[2] is not None, ""),
                                                                       (r[3] is not None, r[3] or "")))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[conv].loss_chars == len(loss)
    assert chat_format.read_back(chat_format.chat_format(df.limit(0))).count() == 0


def test_decontaminate(spark, edge_docs, no_docs):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 8))) for _ in range(n))
    items = [(k, text(rng.randint(12, 60))) for k in range(30)]
    bench = spark.createDataFrame([*items, (98, "too short"), (99, None), (None, "")], "item_id long, text string")
    rows, want = [], {}
    for k in range(90):
        body = [text(40), text(30)]
        if k % 3 == 0:
            item, passage = items[k % 30]
            want[k] = str(item)
            passage = list(passage)
            if k % 2:  # a few edits, below the limit
                for _ in range(max(1, decontaminate.limit_of(len(passage)) // 2)):
                    passage[rng.randrange(5, len(passage))] = "z"
            body.insert(1, "".join(passage).upper().replace(" ", "\n "))
        rows.append((k, " ".join(body)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.hits for r in decontaminate.find_items(df, bench).collect()}
    for k, (_, body) in enumerate(rows):
        assert [h.item_id for h in found[k]] == ([want[k]] if k in want else []), k
        for h in found[k]:
            assert body[h.start:h.end] == body[h.start:h.end].strip()
    assert {r.doc_id for r in decontaminate.keep_clean(df, bench).collect()} == set(range(90)) - set(want)
    assert decontaminate.find_items(edge_docs, bench).where("size(hits) > 0").count() == 0
    assert decontaminate.keep_clean(edge_docs, bench.limit(0)).columns == edge_docs.columns
    assert decontaminate.find_items(no_docs, bench).count() == 0


def test_items_with_one_text_are_all_named():
    text = "what is the first of the many things that two items ask in the very same words"
    index = decontaminate.Index([("b", text), ("a", text.upper()), ("c", text + " again"), ("a", text)])
    assert sorted(n for c in index.classes for n, _ in c.items) == [("a", "b"), ("c",)]
    data = np.frombuffer(text.encode(), np.uint8)
    assert [(h[1], h[4]) for h in index.hits(data, np.array([0, len(data)]))] == [("a", 0), ("b", 0)]


def test_decontaminate_recall():
    """Windows edited to the limit are found as often as the target says; the exact check agrees with brute force."""
    rng = random.Random(11)
    items = [(str(k), " ".join("".join(rng.choice("aeioudnrst") for _ in range(rng.randint(2, 8))) for _ in range(30)))
             for k in range(40)]
    index = decontaminate.Index(items)
    assert all(c.recall >= decontaminate.TARGET_RECALL or len(c.walks) == decontaminate.MAX_WALKS for c in index.classes)
    hits = 0
    for name, text in items * 3:
        new = list(text)
        for _ in range(decontaminate.limit_of(len(text))):
            new[rng.randrange(1, len(new))] = rng.choice("aeioudnrst")
        data = np.frombuffer("".join(new).encode(), np.uint8)
        hits += any(h[1] == name for h in index.hits(data, np.array([0, len(data)])))
    assert hits >= 0.9 * 120


BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def brute_pii(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn or kind == "phone" and 10 <= len(digits) <= 15):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_pii_patterns(docs):
    rng = random.Random(6)
    texts = [r.text for r in docs.collect()] + ["a@b.c@d.e", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "300.1.2.3.4", "x@y", "@a.b",
                                                "+1 (555) 010-9999", "4111-1111 1111 1111", "4111 1111 1111 1112", "1..2.3.4.5"]
    texts += ["".join(rng.choice("a1234567890@.+- ()_") for _ in range(60)) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == brute_pii(text), text
    pii.base_spans("a" * 300_000 + " " + "1" * 300_000 + "." + "9" * 5000 + ".1.1")  # linear


def test_pii_tagger(spark):
    """Spans of texts that training didn't see."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    net = pii.fit(docs.where(~part))
    assert net is not None
    right = wrong = missed = 0
    for r in docs.where(part & F.col("text").rlike("[0-9@]")).collect():
        base = {(s, k, e) for s, k, e in pii.base_spans(r.text)}
        x = pii.codes(r.text)
        starts = pii.window_starts(x)
        if len(starts):
            got = set(pii.learned_spans(x, starts, pii.emissions(net, pii.windows_at(x, starts)), net["move"]))
            right, wrong, missed = right + len(base & got), wrong + len(got - base), missed + len(base - got)
    print("personal data, held out:", right, wrong, missed)
    assert right > 150 and 2 * right / (2 * right + wrong + missed) > 0.9


def test_pii_gradient():
    rng = np.random.default_rng(1)
    score, move = rng.normal(size=(5, 2, pii.TAGS)), rng.normal(size=(pii.TAGS, pii.TAGS))
    tags = rng.integers(0, pii.TAGS, (5, 2))
    _, ds, dm = pii._crf_gradient(score, move, tags)
    for at in [(0, 0, 1), (3, 1, 2)]:
        up = score.copy()
        up[at] += 1e-5
        assert abs((pii._crf_gradient(up, move, tags)[0] - pii._crf_gradient(score, move, tags)[0]) / 1e-5 - ds[at]) < 1e-3
    up = move.copy()
    up[1, 2] += 1e-5
    assert abs((pii._crf_gradient(score, up, tags)[0] - pii._crf_gradient(score, move, tags)[0]) / 1e-5 - dm[1, 2]) < 1e-3


def test_pii_edges(edge_docs, no_docs):
    rows = pii.find_pii(edge_docs, None).collect()
    assert len(rows) == edge_docs.count()
    mail = next(r for r in rows if r.doc_id == 14)
    assert [s.kind for s in mail.spans] == ["email", "phone", "ip", "card"]
    net = pii.fit(edge_docs)
    assert pii.find_pii(edge_docs, net).count() == len(rows) and pii.find_pii(no_docs, net).count() == 0
    assert pii.fit(no_docs) is None


def test_rules_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)] + [(None, 1), (2, None), (77, 1), (1, 0)],
                                   "doc_id long, quality int")
    done = quality_rules.quality_rules(edge_docs, labels).collect()
    assert len(done) == edge_docs.count()
    for r, text in ((r, t) for r in done for d, t in enumerate(edge_docs.select("text").toPandas().text[:16]) if r.doc_id == d and d not in (3, 5)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        again = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)} if len(windows) < 500 else set(range(len(words)))
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (
            len(words), sum(map(len, words)), len(again), len(lines) - len(set(lines)))
        assert r.kept == (not r.base_failed)
    assert quality_rules.quality_rules(no_docs, labels).count() == 0
    assert quality_rules.quality_rules(edge_docs, labels.limit(0)).count() == len(done)


def test_binomial_tail(spark):
    from math import comb
    cases = [(0, 10, 0.1), (3, 50, 0.1), (7, 400, 0.02), (0, 5000, 0.004)]
    df = spark.createDataFrame([c[:2] for c in cases], "k long, n long")
    for k, n, p in cases:
        want = sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        got = df.where((F.col("k") == k) & (F.col("n") == n)).select(
            quality_rules.binomial_tail(F.col("k"), F.col("n"), p)).first()[0]
        assert abs(got - want) < 1e-9


def test_raking_fits_and_matches_plain_loop(spark, docs):
    cells = mixing._keyed(docs).groupBy(*mixing.MARGINS).agg(F.sum("tokens").alias("tokens"))
    targets = {"lang": {"en": 0.4, "fr": 0.3}, "source": None}
    raked = mixing.rake(mixing.with_targets(cells, {k: v for k, v in targets.items() if v})).collect()
    whole = sum(r.tokens for r in raked)
    for margin in ("source", "lang"):
        shares = {}
        for r in raked:
            shares.setdefault(r[margin], [0.0, r[f"target_{margin}"]])[0] += r.weight * r.tokens / whole
        assert all(t is None or abs(s - t) < 1e-3 for s, t in shares.values()), shares
    plain = [[r, 1.0] for r in raked]
    for _ in range(200):
        for margin in mixing.MARGINS:
            mass = {}
            for r, w in plain:
                mass[r[margin]] = mass.get(r[margin], 0) + w * r.tokens
            for p in plain:
                if p[0].tokens:
                    p[1] *= p[0][f"target_{margin}"] * whole / mass[p[0][margin]]
    assert all(abs(r.weight - w) <= 5e-3 * w for r, w in plain if r.tokens)


def test_mixing_sample(spark, docs, edge_docs, no_docs):
    done = mixing.mix_sources(docs).collect()
    whole = sum(r.tokens for r in done)
    assert len(done) == docs.count() and all(0 <= r.probability <= 1 for r in done)
    assert abs(sum(r.tokens * r.probability for r in done) / whole - mixing.BUDGET) < 1e-6
    assert {(r.row.doc_id, r.kept) for r in done} == {(r.row.doc_id, r.kept) for r in mixing.mix_sources(docs).collect()}
    edge = mixing.mix_sources(edge_docs)
    assert edge.count() == edge_docs.count() and edge.select("row.*").columns == edge_docs.columns
    assert mixing.mix_sources(no_docs).count() == 0


def test_mixing_beyond_broadcast(docs, monkeypatch):
    want = sorted((r.row.doc_id, r.kept) for r in mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "MAX_CELLS", 0)
    assert sorted((r.row.doc_id, r.kept) for r in mixing.mix_sources(docs).collect()) == want


def test_native_plans(spark):
    for name in ("op4_mixing", "op5_quality_rules"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stages(spark, edge_docs, tmp_path):
    """Each stage on its own input, with all columns; decisions against the operators' results."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        ids, before = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before
        if name == "ngram_join":
            from test_pairs import brute_join
            want = {d for d, n, c in brute_join([(r.doc_id, r.text) for r in docs.collect()]) if d == c}
            assert ids == want
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [d in ids for d in before if labels.get(d) == 1]
            assert sum(good) >= 0.97 * len(good)
        if name == "decontaminate":
            items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            held = {r.doc_id for r in docs.collect() if any(i in r.text.lower() for i in items)}
            assert not held & ids
        path = str(tmp_path / name)
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    assert 0 < docs.count() < 200


def test_pipeline_edges(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).columns == no_docs.columns and stage(spark, no_docs, SF).count() == 0, name
        if name == "line_dedup":
            left = stage(spark, edge_docs, SF)
            texts = {(r.doc_id, json.dumps(r.text)) for r in left.collect()}
            assert (0, "null") in texts and left.columns == edge_docs.columns
        elif name == "ngram_join":
            left = stage(spark, edge_docs, SF)
            assert left.where("doc_id = 7").count() == 0 and left.where("doc_id = 5").count() == 1
            assert left.where("doc_id = 0 or doc_id = 1").count() == 2
        else:
            assert stage(spark, edge_docs, SF).columns == edge_docs.columns
