"""Collocations against a plain count of all phrases, and the automata against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import automata, collocations
from shelfwise.llm.automata import Counts

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = {}
    candidates = {x: a for x, a in f.items() if len(x) > 2 and a >= least}
    inside = Counter()
    for x, a in candidates.items():
        w = x[1:]
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[(x[0], *w[i : i + k])] = max(a, inside[(x[0], *w[i : i + k])])
    for x, a in candidates.items():
        if 100 * inside[x] < 80 * a:
            score, k = min((2000000 * a // (f[x[: k + 1]] + f[(x[0], *x[k + 1 :])]), k) for k in range(1, len(x) - 1))
            out.setdefault(x[0], []).append((-score, -a, " ".join(x[1:]).encode(), f[x[: k + 1]], f[(x[0], *x[k + 1 :])], k))
    return sorted((lang, r + 1, w.decode(), -a, left, right, n[lang], -s, k) for lang, found in out.items() for r, (s, a, w, left, right, k) in enumerate(sorted(found)[:top]))


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "ß", "éa", "zz\x00", "\x1cq", "a-b", "漢", "x" * 300, "😀"]
    signs = [" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b", " ", ";", ""]
    rows = [("".join(rng.choice(words[: rng.choice([3, 11])]) + rng.choice(signs) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), (" .,\n ", "fr"), ("the of " * 3000, "en"), ("one", "it")] + [("copied text of five words", "es")] * 9


def check(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit("clash") for c in ("phrase", "f", "words", "a", "n", "deal", "range", "data", "x.y")})
    got = collocations.mine(docs, least=5, top=60, **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "k"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 60)


def test_equals_plain_counts(spark):
    check(spark, some_rows(1, 500))


def test_many_small_shards_and_ranges(spark, monkeypatch):
    """Phrases span ranges, shards are cut within texts' groups, automata are united again and again, hot parts are dealt."""
    monkeypatch.setattr(collocations, "MERGE_STATES", 40)
    monkeypatch.setattr("shelfwise.llm.common.HOT_ROWS", 20)
    monkeypatch.setattr("shelfwise.llm.common.HOT_KEYS", 10)
    check(spark, some_rows(2, 300), shard_words=200, range_words=100)


def test_ranges_are_cut_again(spark, monkeypatch):
    """More ranges than the driver may choose: a second step cuts each, by its first parts alone."""
    monkeypatch.setattr(collocations, "CUT_STATES", 30)
    docs = spark.createDataFrame(some_rows(3, 300), "text string, lang string")
    splitters, fine = collocations.boundaries(docs, 1, 100, 3)
    assert 1 <= len(splitters) <= 2 and fine >= 10
    check(spark, some_rows(3, 300), shard_words=200, range_words=100, most=3)


def test_empty_table(spark):
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert collocations.mine(docs.where("false")).count() == 0 and collocations.mine(docs).count() == 0


def build(found):
    keys = sorted(found)
    symbols = pa.array(sorted({s for k in keys for s in k}), pa.large_binary())
    place = {s: i for i, s in enumerate(symbols.to_pylist())}
    rows = np.array([[place[s] for s in k] + [-1] * (4 - len(k)) for k in keys], np.int64).reshape(len(keys), 4)
    return Counts.of_sorted(symbols, rows, np.array([found[k] for k in keys], np.int64))


def listed(counts):
    out = {}
    for d, ends in enumerate(counts.ends):
        states = np.flatnonzero(ends)
        for path, n in zip(counts.paths(d, states), ends[states].tolist()):
            out[tuple(counts.symbols[int(s)].as_py() for s in path)] = n
    return out


KEY = st.lists(st.binary(max_size=2), min_size=1, max_size=4).map(tuple)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(KEY, st.integers(1, 300), max_size=12), min_size=1, max_size=4), st.sets(KEY, max_size=10))
def test_automata(parts, asked):
    made = [Counts.load(build(p).dump()) for p in parts]
    assert [listed(m) for m in made] == parts
    united, total = Counts.union(made), Counter()
    for p in parts:
        total.update(p)
    assert listed(united) == dict(total)
    begins = Counter()
    for k, n in total.items():
        begins.update({k[:d]: n for d in range(1, len(k) + 1)})
    weights = united.weights()
    for d, w in enumerate(weights):
        paths = united.paths(d, np.arange(len(w)))
        assert {tuple(united.symbols[int(s)].as_py() for s in p): n for p, n in zip(paths, w.tolist())} == {k: n for k, n in begins.items() if len(k) == d + 1}
    pieces = united.cut(sorted(asked))
    edges = [None, *sorted(asked), None]
    inside = lambda k, lo, hi: (lo is None or k >= lo) and (hi is None or k < hi)
    want = [(j, {k: n for k, n in total.items() if inside(k, lo, hi)}) for j, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    assert [(j, listed(p)) for j, p in pieces] == [(j, found) for j, found in want if found]
    acceptor = build(dict.fromkeys(asked, 1))
    for d, values in enumerate(united.compose(acceptor, weights)):
        paths = acceptor.paths(d, np.arange(len(values)))
        assert [begins[tuple(acceptor.symbols[int(s)].as_py() for s in p)] for p in paths] == values.tolist()


def test_own_symbols():
    rows = np.array([[0, 3, -1], [2, -1, -1]])
    small = automata.with_own_symbols(pa.array([b"a", b"b", b"c", b"d"], pa.large_binary()), rows, np.array([5, 6]))
    assert small.symbols.to_pylist() == [b"a", b"c", b"d"] and listed(small) == {(b"a", b"d"): 5, (b"c",): 6}
