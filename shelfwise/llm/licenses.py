"""Licence scans with a generalised suffix automaton.

The automaton of all templates' words knows every run of words that stands in
any template.  Each text's words stream through it and give, at every word, the
length of the longest such run that ends there (matching statistics).  Runs of
``LEAST_RUN`` words and more are mapped to their place in the templates they
come from and chained, in order in text and template with few words between,
into covered spans.  A chain gives its label if it holds a phrase that only that
licence has, or a large part of a template, or so many words in a row as
ordinary sentences don't share with it; every such chain is returned.
Words are found over byte arrays, and only runs of ``LEAST_RUN`` words that
stand in some template reach the automaton.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, flat_utf8, table, texts, word_array

#: Phrases and their labels, found wherever their words stand consecutively.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Labels and openings of well-known licence notices, as they stand in source files.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    "mit": "released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl": "this work is licensed under the gnu general public license version 3 this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "cc-by": "this work is licensed under a creative commons attribution 4.0 international license cc by 4.0",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "reserved": "copyright all rights reserved no part of this may be reproduced without permission",
}
#: Whole texts of licences, by label: files of the folder ``license_texts``.
FULL_TEXTS = {"apache-2.0": ["Apache-2.0"], "mit": ["MIT"], "bsd": ["BSD"], "gpl": ["GPL-2", "GPL-3"], "mpl-2.0": ["MPL-2.0"]}
#: Phrases that stand in no text but those of a licence or its mention.
MARKS = {
    "apache-2.0": ["apache license"],
    "mit": ["mit license", "permission is hereby granted free of charge"],
    "bsd": ["redistribution and use in source and binary forms"],
    "gpl": ["gnu general public license"],
    "cc-by": ["creative commons attribution"],
    "mpl-2.0": ["mozilla public license"],
    "reserved": ["all rights reserved"],
}
LEAST_RUN = 3
#: Words that may lie between two runs of one chain, in the text and in the template.
GAP = 6
#: A chain with a mark gives its label from so many covered words on; one without needs
#: so large a share of its template, or so many words with a run of so many among them.
LEAST_COVERED = 4
LEAST_SHARE = 0.55
LEAST_LONG, LONG_RUN = 12, 6


def words_of(text: str) -> list[str]:
    """Lower-case A to Z, then the runs of digits, letters a to z and anything beyond ASCII."""
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def all_templates() -> dict[str, list[str]]:
    """Openings and whole texts, by label."""
    folder = Path(__file__).parent / "license_texts"
    return {label: [opening, *((folder / f"{name}.txt").read_text() for name in FULL_TEXTS.get(label, ()))] for label, opening in TEMPLATES.items()}


class SuffixAutomaton:
    """Of several word sequences; each state knows one place (sequence, end) where its runs stand."""

    def __init__(self, sequences: Sequence[Sequence[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.places[last].add((number, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.places[self.link[state]] |= self.places[state]

    def _new(self, length: int, link: int, to: dict[int, int]) -> int:
        self.next.append(to)
        self.length.append(length)
        self.link.append(link)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The state for runs up to length[state] + 1 that ``to`` stands for, apart from its longer ones."""
        if self.length[to] == self.length[state] + 1:
            return to
        short = self._new(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = short
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = short
            state = self.link[state]
        return short

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another sequence has this run already
            return self._split(last, word, self.next[last][word])
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def statistics(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """At each word, the length of the longest run ending there and its state."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield length, state


@dataclass
class Span:
    label: str
    first: int
    last: int
    covered: int
    share: float


class Scanner:
    """Scans many texts at once for phrases and templates; a label has one template or several."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str | Sequence[str]], marks: dict[str, Sequence[str]] = MARKS) -> None:
        self.phrase_words = [words_of(p) for p in phrases]
        self.phrase_labels = list(phrases.values())
        pairs = [(label, t) for label, several in templates.items() for t in ([several] if isinstance(several, str) else several)]
        self.labels = [label for label, _ in pairs]
        sequences = [words_of(t) for _, t in pairs]
        self.vocabulary = sorted({w for s in [*sequences, *self.phrase_words] for w in s})
        number = {w: k for k, w in enumerate(self.vocabulary)}
        self.sizes = [len(s) for s in sequences]
        coded_sequences = [[number[w] for w in s] for s in sequences]
        self.automaton = SuffixAutomaton(coded_sequences)
        parts = [self._threes(np.array(s, np.int64))[1] for s in coded_sequences]
        self.threes = np.unique(np.concatenate([np.zeros(0, np.int64), *parts]))
        of = {label: [m for m in map(words_of, marks.get(label, ())) if all(w in number for w in m)] for label in templates}
        self.marks = {label: [[number[w] for w in m] for m in several] for label, several in of.items()}
        self.phrases = [[number[w] for w in p] for p in self.phrase_words]
        self.values = pa.array([w.encode() for w in self.vocabulary], pa.large_binary())
        self.longest = max((len(w.encode()) for w in self.vocabulary), default=0)
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        self.low = low
        inside = np.zeros(256, bool)
        inside[48:58] = inside[97:123] = inside[128:] = True
        self.inside = inside

    def words(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number in the vocabulary (or -1) of every word of all texts, and where each text's words start."""
        flat = self.low[flat]
        inside = self.inside[flat]
        begins = np.zeros(len(flat) + 1, bool)
        begins[offsets[:-1]] = True
        start = np.flatnonzero(inside & (begins[:-1] | ~np.concatenate([[False], inside[:-1]])))
        end = np.flatnonzero(inside & np.concatenate([begins[1:-1] | ~inside[1:], [True]])) + 1 if len(flat) else start
        found = np.full(len(start), -1, np.int64)
        few = np.flatnonzero(end - start <= self.longest)
        found[few] = pc.index_in(word_array(flat, start[few], end[few]), self.values).fill_null(-1).to_numpy(zero_copy_only=False)
        return found, np.searchsorted(start, offsets)

    def _threes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where LEAST_RUN known words in a row start, and one number for them."""
        n = max(0, len(words) - LEAST_RUN + 1)
        columns = [words[k : k + n] for k in range(LEAST_RUN)]
        at = np.flatnonzero(np.logical_and.reduce([c >= 0 for c in columns]))
        key = np.zeros(len(at), np.int64)
        for c in columns:
            key = key * len(self.vocabulary) + c[at]
        return at, key

    def _in_templates(self, words: np.ndarray) -> np.ndarray:
        """Whether a word belongs to a run of LEAST_RUN words that stands in a template."""
        inside = np.zeros(len(words), bool)
        at, key = self._threes(words)
        if len(self.threes) and len(at):
            at = at[self.threes[np.minimum(np.searchsorted(self.threes, key), len(self.threes) - 1)] == key]
            for k in range(LEAST_RUN):
                inside[at + k] = True
        return inside

    def _passes(self, template: int, words: list[int], first: int, last: int, covered: int, longest: int) -> bool:
        if covered < LEAST_COVERED:
            return False
        if covered >= LEAST_SHARE * self.sizes[template] or covered >= LEAST_LONG and longest >= LONG_RUN:
            return True
        return any(words[k : k + len(m)] == m for m in self.marks[self.labels[template]] for k in range(first, last + 2 - len(m)))

    def spans(self, words: np.ndarray, base: int) -> list[Span]:
        """Covered template spans of one stretch of words, the first of which is the text's word ``base``.

        Of chains that lie mostly within the same words the one that covers
        most of them stands for all; its share is the largest of its label's.
        """
        coded = words.tolist()
        runs: list[tuple[int, int, int]] = []  # (last word, length, state) of runs that can't go on
        stats = list(self.automaton.statistics(coded))
        for k, (length, state) in enumerate(stats):
            if length >= LEAST_RUN and (k + 1 == len(stats) or stats[k + 1][0] <= length):
                runs.append((k, length, state))
        chains: dict[int, list[list[int]]] = defaultdict(list)  # by template: [first, last, covered, last place in it, longest run]
        found: list[tuple[int, list[int]]] = []

        def close(template: int, before: float) -> None:
            """Runs start ever later, so a chain that ends too far before this start can't go on."""
            for chain in chains[template]:
                if chain[1] + 1 + GAP < before and self._passes(template, coded, chain[0], chain[1], chain[2], chain[4]):
                    found.append((template, chain))
            chains[template] = [c for c in chains[template] if c[1] + 1 + GAP >= before]

        for end, length, state in runs:
            begin = end - length + 1
            places = self.automaton.places[state]
            for template in {t for t, _ in places}:
                close(template, begin)
            for template, place in sorted(places):
                open_at = place - length + 1
                for chain in reversed(chains[template]):
                    if chain[1] < begin <= chain[1] + 1 + GAP and chain[3] < open_at <= chain[3] + 1 + GAP:
                        chain[1], chain[2], chain[3], chain[4] = end, chain[2] + length, place, max(chain[4], length)
                        break
                else:
                    chains[template].append([begin, end, length, place, length])
        for template in list(chains):
            close(template, float("inf"))
        out: list[Span] = []
        owner = np.full(len(coded), -1)
        for template, (first, last, covered, _, _) in sorted(found, key=lambda f: (-f[1][2], f[1][0], f[0])):
            label, share, mine = self.labels[template], covered / self.sizes[template], owner[first : last + 1]
            if 2 * np.count_nonzero(mine >= 0) > len(mine):
                for k in np.unique(mine[mine >= 0]).tolist():
                    if out[k].label == label:
                        out[k].share = max(out[k].share, share)
                continue
            mine[mine < 0] = len(out)
            out.append(Span(label, base + first, base + last, covered, share))
        return out

    def __call__(self, column: pa.Array) -> list[tuple[int, list[tuple[int, int]], list[Span]]]:
        """For each text: its number of words, all places of phrases (phrase, first word), and spans."""
        flat, offsets = flat_utf8(column)
        found, bounds = self.words(flat, offsets)
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        spans: dict[int, list[Span]] = defaultdict(list)
        for number, phrase in enumerate(self.phrases):
            n = len(phrase)
            hit = np.ones(max(0, len(found) - n + 1), bool)
            for k, word in enumerate(phrase):
                hit &= found[k : k + len(hit)] == word
            for at in np.flatnonzero(hit).tolist():
                text = int(np.searchsorted(bounds, at, side="right")) - 1
                if at + n <= bounds[text + 1]:
                    places[text].append((number, at - int(bounds[text])))
        known = np.concatenate([[False], self._in_templates(found), [False]])
        first = np.flatnonzero(~known[:-1] & known[1:])
        last = np.flatnonzero(known[:-1] & ~known[1:])
        # unknown words between two stretches are no longer than a chain's gap may be: such stretches stay together
        for a, b in self._together(first, last, bounds):
            text = int(np.searchsorted(bounds, a, side="right")) - 1
            spans[text] += self.spans(found[a:b], a - int(bounds[text]))
        return [(int(bounds[k + 1] - bounds[k]), places.get(k, []), spans.get(k, [])) for k in range(len(column))]

    def _together(self, first: np.ndarray, last: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        inner = bounds[1:-1]
        pieces: list[list[int]] = []
        text = np.searchsorted(bounds, first, side="right")
        crossing = np.searchsorted(bounds, np.maximum(last - 1, 0), side="right") != text
        long = (last - first >= LEAST_RUN) | crossing
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            cuts = [a, *inner[(inner > a) & (inner < b)].tolist(), b]
            for x, y in zip(cuts, cuts[1:]):
                if y - x < LEAST_RUN:
                    continue
                if pieces and x - pieces[-1][1] <= GAP and np.searchsorted(bounds, x, side="right") == np.searchsorted(bounds, pieces[-1][0], side="right"):
                    pieces[-1][1] = y
                else:
                    pieces.append([x, y])
        yield from ((x, y) for x, y in pieces)


_scanners: dict[int, Scanner] = {}
SCHEMA = "doc_id long, n_words long, places array<struct<label:string,first_word:long>>, spans array<struct<label:string,first_word:long,last_word:long,covered:long,share:double>>"


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str | Sequence[str]] | None = None, marks: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, phrase places and covered template spans, in the order of the text.

    Null and empty texts have no words, places or spans; repeated rows are
    scanned again; texts of any length are scanned whole; other columns play
    no part.  An empty table gives no rows.
    """
    phrases, templates, marks = phrases or PHRASES, templates or all_templates(), MARKS if marks is None else marks
    key = hash((tuple(phrases.items()), repr(templates), repr(marks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanners.get(key) or _scanners.setdefault(key, Scanner(phrases, templates, marks))
        place = pa.struct([("label", pa.string()), ("first_word", pa.int64())])
        span = pa.struct([*place, ("last_word", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])
        types = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(place)), ("spans", pa.list_(span))])
        for batch in batches:
            for part in blocks(batch):
                found = scanner(part["text"])
                places = [[{"label": scanner.phrase_labels[p], "first_word": w} for p, w in sorted(x[1], key=lambda y: (y[1], y[0]))] for x in found]
                row = lambda s: {"label": s.label, "first_word": s.first, "last_word": s.last, "covered": s.covered, "share": s.share}
                spans = [[row(s) for s in sorted(x[2], key=lambda s: (s.first, s.label))] for x in found]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(v, t) for v, t in zip(([x[0] for x in found], places, spans), types.types[1:]))], schema=types)

    return texts(docs).mapInArrow(run, SCHEMA)


def summary(found: DataFrame) -> DataFrame:
    """Digest columns: counts, first and last phrase places, labels, and a score: 1 with a phrase, else the best span's share."""
    join = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, spans = F.col("places.label"), F.col("spans.label")
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max("spans.share"), F.lit(0.0))))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        join(base).alias("base_labels"),
        join(F.concat(base, spans)).alias("labels"),
        score.alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(table(spark, sf_dir, "documents")))
