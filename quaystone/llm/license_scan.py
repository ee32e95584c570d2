"""License scan with a generalised suffix automaton over licence tokens.

The automaton holds the token sequences of all templates and phrases at once. A file's tokens stream through
it: at each token it knows the longest run ending there that occurs in some template (matching statistics).
Runs of ``MIN_RUN`` tokens or more are kept as matches; for each template they are chained in text order
(later in the file and later in the template, gaps of up to ``MAX_GAP`` tokens), and a chain that covers
``MIN_COVER`` of the template adds the template's label with its span.

Tokens outside the licences' vocabulary end every run, so only runs of vocabulary tokens enter the automaton;
they are found for whole batches with numpy. Templates are few and fixed, so the automaton is built once a
worker from the template list, whose size is checked.

Base labels are exact: the places where a phrase's words stand consecutively, seen as the automaton's state
(or a suffix of it) being the phrase.

Defined cases: null and empty texts have no words, no labels and a score of 0; rows that repeat a doc_id each
get a row; a null doc_id stays null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import bounded_batches, id_of, key_of, rows_of

#: Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening passages of public licence texts.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction including without limitation "
           "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in "
                "compliance with the license you may obtain a copy of the license at http www apache org licenses "
                "license 2 0 unless required by applicable law or agreed to in writing software distributed under the "
                "license is distributed on an as is basis",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met redistributions of source code must retain the above copyright notice "
           "this list of conditions and the following disclaimer",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "all-rights-reserved": "all rights reserved",
}
#: Fewest tokens of a match that enters a chain.
MIN_RUN = 3
#: Most tokens between two matches of a chain.
MAX_GAP = 12
#: Share of a template that a chain covers to add its label.
MIN_COVER = 0.6
#: Tokens of all templates together.
MAX_TEMPLATE_TOKENS = 1 << 20
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in text with A-Z lower-cased: digits, letters and all beyond ASCII.
LICENSE_WORDS = bt.spaces((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


class Automaton:
    """Generalised suffix automaton of token sequences (lists of ints)."""

    def __init__(self, sequences: list[list[int]]):
        if sum(map(len, sequences)) > MAX_TEMPLATE_TOKENS:
            raise ValueError("the templates hold more tokens than an automaton a worker is meant for")
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [()]
        for number, sequence in enumerate(sequences):
            state = 0
            for place, token in enumerate(sequence):
                state = self._extend(state, token)
                self.ends[state] += ((number, place + 1),)
        # a state also ends where the states below it in the suffix-link tree end
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]

    def _add(self, length: int, transitions: dict[int, int], link: int) -> int:
        self.next.append(transitions)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(())
        return len(self.next) - 1

    def _split(self, before: int, token: int, state: int) -> int:
        """The state of the strings of ``state`` up to one token more than ``before``."""
        if self.length[state] == self.length[before] + 1:
            return state
        twin = self._add(self.length[before] + 1, dict(self.next[state]), self.link[state])
        self.link[state] = twin
        while before >= 0 and self.next[before].get(token) == state:
            self.next[before][token] = twin
            before = self.link[before]
        return twin

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:  # another sequence has been here
            return self._split(last, token, known)
        new, at = self._add(self.length[last] + 1, {}, 0), last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, token, self.next[at][token])
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest suffix in the automaton at each token."""
        state, length, step = 0, 0, self.next
        for token in tokens:
            while state and token not in step[state]:
                state = self.link[state]
                length = self.length[state]
            if token in step[state]:
                state = step[state][token]
                length += 1
            else:
                length = 0
            yield state, length


class Scanner:
    """The automaton of phrases and templates, with the vocabulary's hashes."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(p.split(), label) for p, label in phrases.items()]
        self.templates = [(label, t.split()) for label, t in templates.items()]
        texts = [p for p, _ in self.phrases] + [t for _, t in self.templates]
        words = sorted({w for t in texts for w in t})
        data, offsets = bt.to_bytes(pa.array(words))
        hashes = bt.Rolling(data, bt.LOWER).of(offsets[:-1], offsets[1:])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {words[o]: i for i, o in enumerate(order)}
        self.automaton = Automaton([[number[w] for w in t] for t in texts])
        self.sizes = [len(t) for t in texts]
        self.shortest = min([MIN_RUN, *(len(p) for p, _ in self.phrases)])
        # phrases that end at a state: those whose whole sequence ends in it, by length
        whole = [[(k, n) for k, n in self.automaton.ends[s] if k < len(self.phrases) and n == self.sizes[k]]
                 for s in range(len(self.automaton.next))]
        self.closing: list[list[tuple[int, int]]] = []
        for state in range(len(self.automaton.next)):
            found, at = {}, state
            while at > 0:
                for k, n in whole[at]:
                    if n <= self.automaton.length[at]:
                        found[k] = n
                at = self.automaton.link[at]
            self.closing.append(sorted(found.items()))

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def scan(self, tokens: list[int], first: int, places: list, matches: list) -> None:
        """Add the phrase places (phrase, start word) and the matches (start word, length, state) of one run of
        vocabulary tokens that starts at word ``first``."""
        previous = (0, 0, 0)
        for k, (state, length) in enumerate(self.automaton.statistics(tokens)):
            for phrase, n in self.closing[state]:
                if length >= n:
                    places.append((phrase, first + k + 1 - n))
            if length <= previous[1] and previous[1] >= MIN_RUN:  # the run before can't be longer
                matches.append(previous)
            previous = (first + k + 1 - length, length, state)
        if previous[1] >= MIN_RUN:
            matches.append(previous)

    def chains(self, matches: list[tuple[int, int, int]]) -> dict[str, tuple[float, int, int]]:
        """Best chain of matches for each template: label -> (share covered, first word, end word)."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, state in sorted(set(matches)):
            for k, end in self.automaton.ends[state]:
                if k >= len(self.phrases) and end >= length:
                    by_template.setdefault(k, []).append((start, length, end - length))
        best: dict[str, tuple[float, int, int]] = {}
        for k, found in by_template.items():
            label, size = self.templates[k - len(self.phrases)][0], self.sizes[k]
            tails: list[tuple[int, int, int, int]] = []  # (end in file, end in template, covered, first word)
            for start, length, at in found:
                covered, first = 0, start
                for end, template_end, so_far, begin in reversed(tails):
                    if start - end > MAX_GAP + size:
                        break
                    if end <= start <= end + MAX_GAP and template_end <= at and so_far > covered:
                        covered, first = so_far, begin
                tails.append((start + length, at + length, covered + length, first))
                share = min(1.0, (covered + length) / size)
                if share > best.get(label, (0.0, 0, 0))[0]:
                    best[label] = (share, first, start + length)
        return best


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
                 cover: float = MIN_COVER) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_base (places of all phrases), first_word and
    last_word (smallest and largest start of a place), base_labels, labels, score (1 with a place, else the largest
    covered share of a template) and spans (label:first:end words of chains that reach ``cover``)."""
    bounded_batches(docs.sparkSession)
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    kept: list[Scanner] = []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Scanner(phrases, templates))
        scanner = kept[0]
        for batch in batches:
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                row, start, end = bt.words(data, offsets, LICENSE_WORDS)
                token = scanner.tokens(bt.Rolling(data, bt.LOWER).of(start, end))
                n_words = np.bincount(row, minlength=high - low)
                firsts = np.concatenate([[0], np.cumsum(n_words)])
                begin, stop = bt.runs(token >= 0, firsts)
                long = stop - begin >= scanner.shortest
                places: dict[int, list] = {}
                matches: dict[int, list] = {}
                for b, e, r in zip(begin[long].tolist(), stop[long].tolist(), row[begin[long]].tolist()):
                    scanner.scan(token[b:e].tolist(), b - int(firsts[r]), places.setdefault(r, []),
                                 matches.setdefault(r, []))
                out = {k: [] for k in ("n_base", "first", "last", "base", "labels", "score", "spans")}
                for r in range(high - low):
                    hits = places.get(r) or []
                    base = {scanner.phrases[k][1] for k, _ in hits}
                    found = scanner.chains(matches[r]) if matches.get(r) else {}
                    added = {label: c for label, c in found.items() if c[0] >= cover}
                    out["n_base"].append(len(hits))
                    out["first"].append(min((s for _, s in hits), default=None))
                    out["last"].append(max((s for _, s in hits), default=None))
                    out["base"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(base | set(added))))
                    out["score"].append(1.0 if hits else max((c[0] for c in found.values()), default=0.0))
                    out["spans"].append(",".join(f"{k}:{c[1]}:{c[2]}" for k, c in sorted(added.items())))
                yield rows_of(doc=batch.column(0).slice(low, high - low), n_words=n_words.astype(np.int64),
                              n_base=pa.array(out["n_base"], pa.int64()), first_word=pa.array(out["first"], pa.int64()),
                              last_word=pa.array(out["last"], pa.int64()), base_labels=pa.array(out["base"], pa.string()),
                              labels=pa.array(out["labels"], pa.string()), score=pa.array(out["score"], pa.float64()),
                              spans=pa.array(out["spans"], pa.string()))

    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text")).mapInArrow(
        scan, "doc long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans string")
    return rows.select(id_of("doc").alias("doc_id"), *rows.columns[1:])
