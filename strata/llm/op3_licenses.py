"""License scan: matching statistics against a generalised suffix automaton.

The automaton is built over the words of all license templates (one unique
separator between them). A document's words stream through it; wherever the
longest match stops growing, the match (length, template, place in the
template) is kept if it has at least ``MIN_MATCH`` words, and so is every part
of it of that many words that also stands in another template (or elsewhere in
the same one). Matches of one
template are chained when they follow each other in both the document and the
template with gaps of at most ``MAX_GAP`` words; a chain that covers enough of
its template is a span with that template's label.

Words are runs of digits, letters a-z (A-Z lower-cased) and everything outside
ASCII. Null and empty texts have no words, no labels and score 0. Repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import map_batches, read

# Base phrases and their labels.
PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The phrases that the query ``op3_licenses`` counts, by its contract.
QUERY_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# License notices (label, words).
TEMPLATES = [
    ("mit", "the mit license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software"),
    ("apache-2", "apache license version 2"),
    ("apache-2", "apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "cc by nc 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
]

MIN_MATCH = 3       # words of a match
MAX_GAP = 10        # words between chained matches
SHORT = 12          # a template of fewer words must be covered to SHORT_COVER, others to LONG_COVER
SHORT_COVER = 0.8
LONG_COVER = 0.5

_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the places
    (template, end) where each state's words occur."""

    def __init__(self, sequences: list[list[bytes]]):
        self.sequences = sequences
        self.vocabulary = {w for s in sequences for w in s}
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]
        last, prefix = 0, []
        for t, sequence in enumerate(sequences):
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                prefix.append((last, t, i))
            last = self._extend(last, ("end", t))
        for state, t, i in prefix:              # a state also occurs where its longer forms do
            while state > 0:
                self.places[state].append((t, i))
                state = self.link[state]

    def _new(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.places.append([])
        return len(self.next) - 1

    def _extend(self, last: int, word) -> int:
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            if self.length[p] + 1 == self.length[q]:
                self.link[state] = q
            else:
                copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
                while p != -1 and self.next[p].get(word) == q:
                    self.next[p][word] = copy
                    p = self.link[p]
                self.link[q] = self.link[state] = copy
        return state

    def matches(self, words: list[bytes], start: int, end: int):
        """(document end, length, state) of the matches of words[start:end]
        that the next word does not extend."""
        state = length = 0
        for i in range(start, end):
            word = words[i]
            grown, at = length, state
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            if grown >= MIN_MATCH and length <= grown:
                yield i, grown, at
        if length >= MIN_MATCH:
            yield end, length, state


def shared_parts(sequences: list[list[bytes]]) -> list[list[tuple[int, int, int, int]]]:
    """Per template, (start, other template, start there, words) of the longest
    common runs of at least MIN_MATCH words; a template shares itself."""
    out = []
    for own in sequences:
        parts = []
        for t, other in enumerate(sequences):
            for shift in range(-len(other) + 1, len(own)):         # own[i] meets other[i - shift]
                i, stop = max(0, shift), min(len(own), len(other) + shift)
                while i < stop:
                    j = i
                    while j < stop and own[j] == other[j - shift]:
                        j += 1
                    if j - i >= MIN_MATCH:
                        parts.append((i, t, i - shift, j - i))
                    i = j + 1
        out.append(parts)
    return out


def spans(automaton: SuffixAutomaton, shared: list[list[tuple[int, int, int, int]]], labels: list[str], words: list[bytes]) -> list[tuple[int, int, str, float]]:
    """(first word, last word, label, coverage) of the covered template spans."""
    known = automaton.vocabulary
    inside = [w in known for w in words]
    by_template: dict[int, set[tuple[int, int, int]]] = {}
    i, n = 0, len(words)
    while True:
        try:
            i = inside.index(True, i)
        except ValueError:
            break
        j = i
        while j < n and inside[j]:
            j += 1
        if j - i >= MIN_MATCH:
            for end, length, state in automaton.matches(words, i, j):
                own, place = automaton.places[state][0]      # any place: the words are the same
                low, high = place + 1 - length, place + 1
                for start, t, there, size in shared[own]:
                    a, b = max(start, low), min(start + size, high)
                    if b - a >= MIN_MATCH:
                        by_template.setdefault(t, set()).add((end - high + a, end - high + b, there + a - start))
        i = j
    out = []
    for t, found in by_template.items():
        size = len(automaton.sequences[t])
        need = SHORT_COVER if size < SHORT else LONG_COVER
        found = whole_matches(found)
        chains: list[tuple[int, int, int, int]] = []     # first, end, template end, covered words
        for a, b, at in found:
            grown = None
            for k in range(len(chains) - 1, -1, -1):
                first, end, stop, covered = chains[k]
                if a - end > MAX_GAP:
                    break
                if a >= end and 0 <= at - stop <= MAX_GAP and (grown is None or covered > chains[grown][3]):
                    grown = k
            if grown is None:
                chains.append((a, b, at + b - a, b - a))
            else:                                # the chain moves to the end: chains stay in order of their ends
                first, _, _, covered = chains.pop(grown)
                chains.append((first, b, at + b - a, covered + b - a))
        best = [(c / size, first, end) for first, end, _, c in chains if c >= need * size]
        out += [(first, end - 1, labels[t], min(1.0, share)) for share, first, end in best]
    return sorted(set(out))


def whole_matches(found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches (start, end, template start) with those of one diagonal that
    overlap made one (parts of the same match seen from different longer ones)."""
    out: list[tuple[int, int, int]] = []
    for a, b, at in sorted(found, key=lambda m: (m[0] - m[2], m[0], m[1])):
        if out and out[-1][0] - out[-1][2] == a - at and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, at))
    return sorted(out)


def base_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(start word, label) of every place of a base phrase."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        want = b" " + phrase.encode() + b" "
        at, counted, word = line.find(want), 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)
            out.append((word, label))
            counted, at = at, line.find(want, at + 1)
    return sorted(out)


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES):
        self.phrases = phrases
        self.labels = [label for label, _ in TEMPLATES]
        self.automaton = SuffixAutomaton([t.encode().split() for _, t in TEMPLATES])
        self.shared = shared_parts(self.automaton.sequences)
        grams = (s[i:i + MIN_MATCH] for s in self.automaton.sequences for i in range(len(s) - MIN_MATCH + 1))
        common = set(b"the of and to in is or a it as at by for from any all this that with not are you may".split())
        self.marks = {w for g in grams for w in (set(g) - common or set(g))}
        self.marks |= {w for p in phrases for w in (set(p.encode().split()) - common or set(p.encode().split()))}

    def scan(self, text: str | None):
        """(words, base places, spans) of a whole text."""
        words = words_of(text)
        if self.marks.isdisjoint(words):         # every match and every base phrase holds a mark
            return words, [], []
        return words, base_places(words, self.phrases), spans(self.automaton, self.shared, self.labels, words)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<first_word, last_word, label, coverage>>)."""
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()),
                               ("coverage", pa.float64())]))

    def make():
        own = Scanner()

        def fn(batch):
            out = [[dict(zip(("first_word", "last_word", "label", "coverage"), s)) for s in own.scan(t)[2]]
                   for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, item)], ["doc_id", "spans"])
        return fn
    return map_batches(docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text"), make,
                       f"doc_id {kind}, spans array<struct<first_word: bigint, last_word: bigint, label: string, "
                       "coverage: double>>").withColumnRenamed("doc_id", id_col)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")

    def make():
        own = Scanner(QUERY_PHRASES)

        def fn(batch):
            rows = []
            for text in batch.column("text").to_pylist():
                words, base, found = own.scan(text)
                starts = [a for a, _ in base]
                names = sorted({label for _, label in base})
                rows.append((len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(names),
                             ",".join(sorted({s[2] for s in found} | set(names))), max((s[3] for s in found), default=0.0)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, zip(*rows), types)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
        return fn
    return map_batches(docs.select("doc_id", "text"), make,
                       "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                       "base_labels string, labels string, score double")
