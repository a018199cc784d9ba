"""The operators against brute force, the libraries, and on nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import common, exact_dedup, html_text, jaccard, language, licenses, packing, sentencepieces, token_counts, topk, toxicity

LOWER = {c: c + 32 for c in range(65, 91)}
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Hello world, it's 'll fine <|endoftext|> x"), (5, "Hello world, it's 'll fine <|endoftext|> x"), (6, "é漢字 😀 ▁▁ Ωß \x00\x1c a  b"), (7, "word " * 9000), (8, "x" * 5000), (9, "a b"),
    (10, "All Rights Reserved. cc-BY general public license"), (None, "no id"), (None, "no id"), (11, "Hello world, it's 'll fine <|endoftext|> x"), (11, "Hello world, it's 'll fine <|endoftext|> x"), (12, "́combining İ Σ ﬁ 　 <s> </s> <0x0A>"), (13, "=" * 700 + "\n\n\n"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows, with columns named like those that operators make."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(1).cast("long"), **{c: F.lit("clash") for c in ("id", "sha", "_sha", "maybe", "n", "sig", "component_id", "kept", "keep_id", "word", "_gone", "score", "toxic")}})


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def empty(df):
    return df.where("false")


def sets_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute_components(rows, size, num, den):
    items = [(i, sets_of(t, size)) for i, t in rows]
    parent = {i: i for i, _ in items if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            if a and b and i is not None and j is not None and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in items), key=repr)


# ------------------------------------------------------------------ 1


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)


@pytest.mark.parametrize("bits", [None, 64])
def test_exact_dedup(odd, docs, bits):
    for df in (odd, docs, odd.union(odd).repartition(7), empty(odd)):  # with 64 bits nearly all are set
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = exact_dedup.exact_groups(df, bits=bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert sorted(map(tuple, got.collect()), key=repr) == brute_dedup(rows)
        left = exact_dedup.drop_exact_copies(df, bits=bits)
        assert left.columns == df.columns
        stay = [(r["doc_id"], r["text"] or "") for r in left.collect()]
        assert sorted(t for _, t in stay) == sorted({t or "" for _, t in rows})
        assert all(i == max((j for j, u in rows if (u or "") == t and j is not None), default=None) for i, t in stay)


def test_rows_that_pass_never_shuffle(docs):
    """Below every exchange of the plan stands the filter of the possibly repeated rows, or an aggregate."""
    for df in (exact_dedup.exact_groups(docs), exact_dedup.drop_exact_copies(docs)):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        assert not any("text#" in line for line in lines if "Exchange" in line)
        for k, line in enumerate(lines):
            if "Exchange" in line:
                below = next(x for x in lines[k + 1 :] if "Project" not in x and "Filter isnotnull" not in x)
                assert any(part in below for part in ("getbit(", "HashAggregate", "Window", "Scan ExistingRDD")), lines[k : k + 4]
    flags = exact_dedup.possible(exact_dedup.settled(docs.select(exact_dedup.digest(F.col("text")).alias("sha"), F.spark_partition_id().alias("p")), "p"), "sha", "p", "f")
    repeated = sum(n for n in Counter(r["text"] or "" for r in docs.collect()).values() if n > 1)
    assert repeated <= flags.where("f").count() <= repeated + 0.05 * docs.count() + 3


def test_dedup_plan_is_native(odd):
    assert "Python" not in exact_dedup.exact_groups(odd)._jdf.queryExecution().toString()


# ------------------------------------------------------------------ 2


def test_packing_round_trip(spark, odd, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.VOCABULARY)
    library = Tokenizer.from_file(path)
    for df in (odd, docs):
        rows = df.select(F.monotonically_increasing_id().alias("doc_id"), "text").collect()
        want = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows}
        table = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
        pieces = packing.pack_documents(table.repartition(3), path, held=50).collect()
        digests = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.digests(packing.pack_documents(table.repartition(3), path, held=50)).collect()}
        assert digests == {(p["sequence_id"], p["offset"]): zlib.crc32(p["ids"]) for p in pieces}
        texts, sequences = defaultdict(list), defaultdict(list)
        for p in pieces:
            texts[p["doc_id"]].append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
            sequences[p["sequence_id"]].append((p["offset"], p["length"]))
            assert p["length"] == len(p["ids"]) // 4 > 0 and p["doc_tokens"] == len(want[p["doc_id"]])
        assert {d: [i for _, part in sorted(v) for i in part] for d, v in texts.items()} == want
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at == 2048 or at & (at - 1) == 0
    assert packing.pack_documents(empty(odd), path).count() == 0


def test_packing_tasks_hold_little(monkeypatch):
    """Common texts need neither the parsed vocabulary nor the library, and what is held is given in batches of some MB."""
    import tracemalloc

    source, kinds = open(public_tokenizers.path(packing.VOCABULARY)).read(), packing.character_classes()
    tables, seen = packing.word_tables(source), []
    tracemalloc.start()
    encode = packing.WordIds(source, kinds, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6
    encode(["Plain words, and 12 more."])
    assert "library" not in vars(encode)
    assert encode(["word e\u0301"]) == [np.array(encode.library.encode("word e\u0301", add_special_tokens=False).ids, "<u4").tobytes()]

    class Table:
        def mapInArrow(self, function, schema):
            seen.append(function)

    monkeypatch.setattr(packing, "texts", lambda *_: Table())
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    packing.pack_documents(None, public_tokenizers.path(packing.VOCABULARY), held=3000)
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": [f"word {k} " * (200 + k % 50) for k in range(3000)]})
    sent = list(seen[0](iter([docs])))
    assert max(b.nbytes for b in sent) < 2e6 and sum(b.nbytes for b in sent) > 6e6
    assert sorted(set(pa.Table.from_batches(sent)["doc_id"].to_pylist())) == list(range(3000))


def test_combinations_fill_the_window():
    rng = np.random.default_rng(0)
    histogram = np.bincount(rng.integers(1, 128, 3000), minlength=128)
    rows = packing.combinations(histogram, 128)
    assert len(rows) and (rows.sum(axis=1) == 128).all()
    x = packing.solve_counts(rows, histogram)
    counts = packing.round_counts(x, rows, histogram)
    used = np.bincount(rows.ravel(), np.repeat(counts, 3), 128)[1:]
    assert (x >= 0).all() and (used <= histogram[1:]).all() and used.sum() > 0.8 * histogram[1:].sum()


# ------------------------------------------------------------------ 3, 8


def test_token_counts(odd, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library = Tokenizer.from_file(path)
    for df in (odd, docs):
        want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.collect()), key=repr)
        assert sorted(map(tuple, token_counts.count_tokens(df, path).collect()), key=repr) == want
    assert token_counts.count_tokens(empty(odd), path).count() == 0


def test_transducer_on_random_texts_and_small_chunks():
    from tokenizers import Tokenizer

    source = open(public_tokenizers.path(token_counts.VOCABULARY)).read()
    count, library = token_counts.counter(source, token_counts.character_classes()), Tokenizer.from_str(source)
    random.seed(5)
    parts = [*" \n\t'sdtmrevlaZ19!é漢Ωß　😀.", "<|endoftext|>", "  ", "'ll", "'re", "tion", "the "]
    docs = ["".join(random.choices(parts, k=random.randint(0, 50))) for _ in range(3000)] + ["a" * 3000, "漢" * 900]
    assert count(docs).tolist() == [len(e.ids) for e in library.encode_batch(docs, add_special_tokens=False)]
    machine = token_counts.Transducer(source, max_states=300)  # starts anew again and again
    data = " ".join(docs[:200]).encode()
    flat = np.frombuffer(data, np.uint8)
    start = np.zeros(len(flat), bool)
    start[::37] = True
    start[0] = True
    whole = token_counts.Transducer(source).changes(flat, start, chunk=100_000)
    for chunk in (16, 1000):
        assert (machine.changes(flat, start, chunk=chunk) == whole).all()


def test_transducer_keeps_to_its_states_within_a_text():
    from tokenizers import Tokenizer

    source = open(public_tokenizers.path(token_counts.VOCABULARY)).read()
    library, machine = Tokenizer.from_str(source), token_counts.Transducer(source, max_states=1500)
    random.seed(9)
    for text in ("".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=30_000)), base64.b64encode(random.randbytes(9000)).decode()):
        pieces = re.findall(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+", text)  # the pre-tokens of such texts
        start = np.zeros(len(text), bool)
        start[np.cumsum([0, *map(len, pieces[:-1])])] = True
        for chunk in (64, 512):
            assert machine.changes(np.frombuffer(text.encode(), np.uint8), start, chunk).sum() == len(library.encode(text).ids)
            assert len(machine.keys) <= 1500 + 2 * len(text) // chunk + 100


def test_adjacent_tokens_by_brute_force():
    machine = token_counts.Transducer(open(public_tokenizers.path(token_counts.VOCABULARY)).read())

    def merged(text):
        parts = [text[k : k + 1] for k in range(len(text))]
        while len(parts) > 1:
            rank, k = min((machine.rank.get(pair, 1 << 30), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    random.seed(3)
    every = sorted(machine.tokens)
    short = [t for t in every if len(t) <= 4]
    some = [(random.choice(pool), random.choice(pool)) for pool in (every, short) for _ in range(4000)] + [(bytes([c]) * i, bytes([c]) * j) for c in b"aeos -=" for i in range(1, 9) for j in range(1, 9)]
    for a, b in some:
        if a in machine.tokens and b in machine.tokens and merged(a) == [a] and merged(b) == [b]:
            assert machine._adjacent(a, b) == (merged(a + b) == [a, b])


def test_sentencepiece(odd, docs):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path(sentencepieces.VOCABULARY)
    library = SentencePieceProcessor(model_file=path)
    for df in (odd, docs):
        want = []
        for r in df.collect():
            ids = library.encode(r["text"] or "")
            want.append((r["doc_id"], len(ids), ",".join(map(str, ids)), library.decode(ids)))
        assert sorted(map(tuple, sentencepieces.encode_decode(df, path, check=False).collect()), key=repr) == sorted(want, key=repr)
    encoder = sentencepieces.AgendaEncoder(open(path, "rb").read())
    encoder([r["text"] or "" for r in docs.collect()])
    assert encoder.differing == 0
    assert encoder._encode([" hello", "▁tion"]) == [library.encode("hello"), library.encode("tion")]


def test_sentencepiece_long_words_of_other_blocks():
    encoder = sentencepieces.AgendaEncoder(open(public_tokenizers.path(sentencepieces.VOCABULARY), "rb").read())
    random.seed(8)
    words = ["abc" * 100, "xyz" * 100, "漢字仮名" * 50, "語" * 200, base64.b64encode(random.randbytes(700)).decode(), thue_morse(1024), thue_morse(1024, True), thue_morse(200), thue_morse(200, True), "これは空白のない長い文章です。" * 30]
    for word in words:  # each first in its block
        (n, ids, shown), other = encoder([word, "a b"])
        assert shown == word and other[2] == "a b"
        assert list(map(int, ids.split(","))) == encoder.library.encode(word) and n == len(encoder.library.encode(word))
    letters = [*"etaoin shrdlu", " ", "  ", "漢", "é", "😀", "the ", "▁", "\n"]
    for _ in range(60):  # many blocks through one encoder
        texts = ["".join(random.choices(letters, k=random.randint(0, 400))) for _ in range(5)]
        want = [encoder.library.encode(t) for t in texts]
        assert [f[:2] for f in encoder(texts)] == [(len(w), ",".join(map(str, w))) for w in want]
    assert encoder.differing == 0
    assert sentencepieces.AgendaEncoder(open(public_tokenizers.path(sentencepieces.VOCABULARY), "rb").read(), check=False)(words) == encoder(words)


def test_sentencepiece_heap_for_very_long_words(monkeypatch):
    encoder = sentencepieces.AgendaEncoder(open(public_tokenizers.path(sentencepieces.VOCABULARY), "rb").read(), check=False)
    batched, many = [], encoder._encode_many
    monkeypatch.setattr(encoder, "_encode_many", lambda words: batched.extend(words) or many(words))
    rng = np.random.default_rng(8)
    letters = np.array(list("etaoinshr▁é漢😀ß=\n.0"))
    texts = ["".join(rng.choice(letters, n)) for n in (257, 300, 1000, 5000)] + ["x" * 5000, "▁" * 700 + "a", " " * 400 + "the" * 300, "the" * 100_000]
    for text, (n, ids, shown) in zip(texts, encoder(texts)):
        want = encoder.library.encode(text)
        assert (n, ids, shown) == (len(want), ",".join(map(str, want)), encoder.library.decode(want))
    assert max(map(len, batched)) <= sentencepieces.HEAP_LENGTH
    for text in texts[:-1]:  # both ways agree
        assert [encoder.word(" " + text.replace(" ", "").replace("▁", ""))] == many([" " + text.replace(" ", "").replace("▁", "")])


# ------------------------------------------------------------------ 4, 10


def test_language(odd, docs):
    network = language.train(docs)
    found = language.identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.93
    crc = {r["doc_id"]: r["held_out"] for r in found.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in crc.items())
    rows = {r["doc_id"]: r for r in language.identify(odd, network).collect()}
    assert [rows[k]["lang_pred"] for k in (1, 2, 3, 13)] == ["und"] * 4 and all(0 <= r["score"] <= 1 for r in rows.values())
    kept = language.keep_identified(odd, network, 0.35)
    assert kept.columns == odd.columns and not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}
    assert language.identify(empty(odd), network).count() == language.keep_identified(empty(odd), network, 0.35).count() == 0
    assert language.train(empty(odd)).languages == []
    assert {r["lang_pred"] for r in language.identify(odd, language.train(empty(odd))).collect()} == {"und"}


def test_language_of_short_documents_is_learned(spark):
    rows = [(k, "de" if k % 2 else "el", f"guten tag {k}" if k % 2 else f"καλη {k}") for k in range(200)] + [(201 + 2 * k, "xx", "12 ...") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    network = language.train(df, steps=60)
    assert network.languages == ["de", "el"]
    found = language.identify(df, network).join(df, "doc_id").where("lang <> 'xx'")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_letters_are_those_of_unicode():
    network = language.Network.fresh(["a", "b"])
    import pyarrow as pa

    names, score = language.label_texts(network, pa.array(["²½①", "_1", "ª", "漢", "x", "", None, "٣", "\u0301"]))
    assert [n == "und" for n in names] == [True, True, False, False, False, True, True, True, True] and all((s == 0) == (n == "und") for n, s in zip(names, score))


def test_language_equals_one_position_at_a_time():
    from brute import language_probabilities

    rng = np.random.default_rng(5)
    network = language.Network.fresh(["a", "b", "c"], hidden=4)
    for p in network.parameters():
        p[...] = rng.normal(0, 0.6, p.shape)
    for g in network.gates:
        g[language.PAD] = [60.0] * 4 + [0.0] * 8
    texts = [b"x", b"hello", "漢字 и ß".encode(), rng.integers(0, 256, 255).astype(np.uint8).tobytes(), rng.integers(0, 256, 256).astype(np.uint8).tobytes(), rng.integers(0, 256, 1700).astype(np.uint8).tobytes(), b""]
    got = network.documents(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), lanes=3)
    for text, p in zip(texts, got):
        assert np.allclose(p, language_probabilities(network, text), atol=1e-4)


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    network = language.Network.fresh(["a", "b"], hidden=3)
    for p in network.parameters():
        p[...] = rng.normal(0, 0.5, p.shape)
    rows, target = rng.integers(0, 256, (6, 4)), np.array([0, 1, 1, 0])

    def loss():
        p = network.probabilities(rows)
        return -np.log(p[:, np.arange(4), target]).mean()

    for p, g in zip(network.parameters(), network.gradients(rows, target)):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = p[k], 1e-2
        p[k] = keep + step
        up = loss()
        p[k] = keep - step
        slope = (up - loss()) / (2 * step)
        p[k] = keep
        assert abs(slope - g[k]) < 0.05 * abs(g[k]) + 1e-4


def test_toxicity(spark, sf_dir, odd, docs):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    even = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    held = toxicity.score(docs, even).withColumnRenamed("toxic", "found").join(labels.where("doc_id % 2 = 1"), "doc_id")
    row = held.agg(F.avg((F.col("found") == (F.col("toxic") == 1)).cast("int")).alias("right"), F.avg(F.when(F.col("toxic") == 0, F.col("found").cast("int"))).alias("wrong")).first()
    assert row["right"] > 0.9 and row["wrong"] < 0.03
    assert toxicity.score(odd, even).count() == len(ODD)
    left = toxicity.reject_toxic(odd, even)
    assert left.columns == odd.columns and left.count() >= len(ODD) - 1
    none = toxicity.train(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.score(odd, none).where("toxic").count() == 0


def test_toxicity_by_brute_force(spark, sf_dir, odd):
    """The chosen features and the chain's probabilities, a document at a time."""
    from brute import best_features, chain_probabilities

    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{t}.parquet").where("doc_id < 400") for t in ("documents", "labels"))
    twice = docs.union(docs.limit(3)).withColumn("quality", F.lit("clash"))  # repeated ids and texts
    chain = toxicity.train(twice, labels)
    marks = {r["doc_id"]: (int(r["quality"] == 0), int(r["toxic"] == 1), int(r["toxic"] == 1 and r["quality"] == 0)) for r in labels.dropna().collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert set(chain.vocabulary) == best_features([(texts[i], y) for i, y in marks.items() if i in texts])
    for table in (docs, odd, empty(odd)):
        rows = table.select("doc_id", "text").collect()
        want = sorted(((r["doc_id"], *(round(p, 9) for p in chain_probabilities(chain, r["text"] or ""))) for r in rows), key=repr)
        got = toxicity.score(table, chain)
        assert sorted(((r[0], *(round(p, 9) for p in r[1:-1])) for r in got.collect()), key=repr) == want
        assert got.where("toxic <> (p_toxic >= 0.5)").count() == 0
    long = chain_probabilities(chain, "word " * 400_000 + texts[min(marks)])
    assert np.allclose(chain(["word " * 400_000 + texts[min(marks)]])[0], long)
    assert toxicity.score(odd, toxicity.train(empty(docs), empty(labels))).where("toxic").count() == 0


# ------------------------------------------------------------------ 5


def test_html(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = html_text.learn_weights(pages)
    import html as entities

    for r in html_text.extract_pages(pages, weights).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", body))
        assert r["text"] == "\n".join(b for b in blocks if b)
    page = '<body><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies here</div><article><h2>A &amp; B</h2><p>First <b>para</b>\n graph of the text<p>Second one, rather long too<div class="ad">Buy now</div><form>Sign up</form><p>Third para, the last of all<section class="comments"><p>nice!</p></section></article><footer>(c)</footer>'
    assert html_text.extract(page, weights) == "A & B\nFirst para graph of the text\nSecond one, rather long too\nThird para, the last of all"
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "</p></div>&lt;<"), (5, "u", "<p>" * 3000 + "x")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert {r["page_id"]: r["text"] for r in html_text.extract_pages(odd, weights).collect()}[1] == ""
    assert html_text.extract_pages(empty(odd), html_text.learn_weights(empty(odd))).count() == 0


def test_html_keeps_both_sides_of_long_outside_elements(spark, sf_dir):
    weights = html_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    prose = lambda n, w: " ".join(f"{w}{k}" for k in range(n))
    menu = '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="sidebar">' + prose(90, "side") + "</div>"
    for between in (f'<div class="ad">{prose(100, "buy")}</div>', f"<aside>{prose(40, 'note')}</aside>", "<form>" + f"<p>{prose(9, 'ask')}</p>" * 40 + "</form>", '<div class="comments">' + f"<div><a>{prose(30, 'nice')}</a></div>" * 20 + "</div>"):
        for first, last in ((20, 200), (200, 20)):
            page = f"<html><body>{menu}<article><h1>The title</h1><p>{prose(first, 'a')}</p>{between}<p>{prose(last, 'b')}</p></article><footer>{prose(60, 'foot')}</footer></body></html>"
            assert html_text.extract(page, weights) == f"The title\n{prose(first, 'a')}\n{prose(last, 'b')}"


def test_html_classes_and_self_closed_elements(spark, sf_dir):
    weights = html_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    inner, want = "<h1>The title</h1><p>First words of the text<p>and the last ones of it", "The title\nFirst words of the text\nand the last ones of it"
    article = f"<article>{inner}</article>"
    for page in (
        f"<body class='no-sidebar'>{article}</body>", f"<body class='sidebar widget'>{article}</body>", f"<html class=menu><body id='page'><div id='page' class='has-menu'>{article}</div></body>", f"<div class='menu share'><div class=widget>{article}</div></div>",
        f"<body><article class='post has-comments'>{inner}</article></body>", f"<body><article class='share'>{inner}</article></body>", f"<body><main class='share-enabled'>{inner}</main></body>", f"<body><div class='sidebar'><main class='widget'>{inner}</main></div></body>",
        f'<body><svg width="5"/>{article}</body>', f"<body><math/>{article}<svg></svg></body>", f"<body><svg/>{article}<svg><path/></svg></body>", f"<body><canvas/>{article}</body>", f"<body><canvas/>{article}<canvas></canvas></body>", f"<body><script src='a.js'/>{article}<script>x</script></body>",
        f"<body>{article}<div class='comment-list'><article class='comment'><p>nice one</p></article></div></body>", f"<body><div class='ad-slot'>buy</div>{article}<div class='site-footer'>bye</div><div class='related-posts'><article><p>Other</p></article></div></body>",
    ):
        assert html_text.extract(page, weights) == want, page
    assert html_text.extract("<body><p>Seen<script src='a.js'>x</script><svg><title>t</title><path/></svg> text</p><script>rest", weights) == "Seen text"
    assert len(html_text.tokens("<svg>" * 20_000 + "<script/>" * 20_000 + "x</script>")) > 40_000


#: Pages as sites write them, and the text that a reader marked by hand.
LABELLED = [
    ("<html><body class='no-sidebar'><div id='nav'><a href='/'>Home</a> <a href='/a'>About us</a></div><div id='content'><h1 class='section-header'>Tides</h1><div class='entry'>The sea rises twice a day.<br>Then it falls again, and so on.</div><div class='share-buttons'><a>Share</a></div></div><div id='footer'>All rights reserved by the owner</div></body></html>", "Tides\nThe sea rises twice a day. Then it falls again, and so on."),
    ("<body><header><a href='/'>Daily News</a><form>Search <input></form></header><main><h2>Rain &amp; wind</h2><p>It rained\n for  days.</p><aside>Read more here</aside><p class='lead'>People stayed in their houses.</p></main><footer>Imprint</footer></body>", "Rain & wind\nIt rained for days.\nPeople stayed in their houses."),
    ("<body class='home has-navigation'><article><h1 class='section-header'>One</h1><p>First part of it.</p><div class='ad-slot'>Buy now and save much money today</div><p>Second part of it.</p><section id='comments'><h3>2 comments</h3><p>Great text, thank you</p></section></article></body>", "One\nFirst part of it.\nSecond part of it."),
    ("<body><ul class='menu'><li><a href='/'>Start</a><li><a href='/b'>Board</a></ul><div><div><p>Some words about the old bridge over the river.<p>More words on who built it, and when.</div></div><div class='cookie-notice'>We use cookies</div></body>", "Some words about the old bridge over the river.\nMore words on who built it, and when."),
    ("<form id='aspnetForm'><div class='widget'><a>Log in</a></div><main><h1>Report</h1><table><tr><td>Year<td>2020</tr></table><blockquote>So they said to us.</blockquote></main></form>", "Report\nYear\n2020\nSo they said to us."),
]


def test_html_pages_labelled_by_hand(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for weights in (html_text.learn_weights(pages), html_text.learn_weights(empty(pages))):
        for page, want in LABELLED:
            assert html_text.extract(page, weights) == want


def test_html_time_is_linear_in_nesting():
    import time

    took = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        assert len(html_text.tokens("<b>" * n + "<div>x" * n + "</b>" * n + "</i>" * n)) == 5 * n
        assert len(html_text.tokens("<nav>" * n + "<main>x" * n)) == 3 * n
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0]


def test_html_containers_are_fitted_to_pages():
    counts = {("name:div", "word:share"): (400.0, 2.0), ("name:div", "word:teaser"): (0.0, 300.0), ("name:div",): (50.0, 40.0), ("name:p", "word:ad"): (0.0, 90.0)}
    fitted = html_text.Containers.fit(counts)
    asked = {a: fitted.outside("div", f"class='{a}'") for a in ("share", "teaser", "plain", "ad", "no-sidebar")}
    assert asked == {"share": False, "teaser": True, "plain": False, "ad": True, "no-sidebar": False}
    assert html_text.Containers().outside("div", "class='share'") and not html_text.Containers().outside("div", "class='teaser'")


def test_best_region():
    rng = np.random.default_rng(3)
    for _ in range(50):
        s = rng.integers(-5, 5, 20).astype(float).tolist()
        a, b = html_text.best_region(s)
        assert sum(s[a:b]) == max(0.0, max(sum(s[i:j]) for i in range(20) for j in range(i + 1, 21)))


# ------------------------------------------------------------------ 6


def brute_top(rows, k, every):
    sound = [(i, [np.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in sound:
        if i % every == 0:
            best = sorted((-int(np.dot(v, w)), j) for j, w in sound if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def clustered(rng, n, width, copies):
    """Vectors of length 1, evenly spread, and ``copies`` near each of the first ten."""
    v = rng.normal(0, 1, (n, width))
    v = np.concatenate([v, np.repeat(v[:10], copies, axis=0) + rng.normal(0, 0.02 * width**0.5, (10 * copies, width))])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_top_k(spark, sf_dir, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(0, 0.4, 8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)] + [(400, None), (420, [1.0, None] + [0.0] * 6), (440, [float("nan")] + [0.0] * 7), (460, [float("inf")] + [0.0] * 7), (None, [0.0] * 8)]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(clustered(rng, 200, 8, 40))]
    schema = "vec_id long, embedding array<float>"
    for block, pivots in ((100, 5), (topk.CANDIDATES, topk.PIVOTS)):
        monkeypatch.setattr(topk, "CANDIDATES", block)
        monkeypatch.setattr(topk, "QUERIES", 10)
        monkeypatch.setattr(topk, "PIVOTS", pivots)
        df = spark.createDataFrame(rows, schema).withColumn("v", F.lit("clash"))
        assert sorted(map(tuple, topk.top_k(df, 5, 20).collect())) == brute_top(rows, 5, 20)
    assert topk.top_k(empty(df)).count() == 0
    few = df.where("vec_id < 3")
    assert topk.top_k(few).count() == 2


def test_top_k_widths_repeats_and_large_numbers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 3 if i % 3 else 5).tolist()) for i in range(200)] + [(20, [1.0, 0.0, 1.0]), (20, [1.0, 0.0, 1.0]), (500, []), (501, [])]
    rows += [(600 + i, [float(rng.integers(0, 1 << 24)) + 0.5, 1.0 + i % 2, 3.0, -1.0]) for i in range(60)]  # products beyond 2^53
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 7, 20).collect()
    sound = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    want = set()
    for i, v in sound:
        if i % 20 == 0:
            some = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in sound if j != i and len(v) == len(w)]
            want.add((i, tuple(v), tuple(sorted(some)[:7])))
    for i in {i for i, _, _ in want}:
        mine = sorted((s for k, v, some in want if k == i for s in some))[:7] if i != 20 else None
        found = sorted((-r["score"], r["vec_id"]) for r in got if r["query_id"] == i)
        assert len(found) <= 7 and (mine is None or found == mine)


def test_pivots_eliminate_what_they_can():
    rng = np.random.default_rng(6)
    v = np.floor(64 * clustered(rng, 3000, 64, 60)).astype(np.int64)
    ids = np.arange(len(v))
    pivots = v[rng.choice(len(v), 64, replace=False)].astype(float)
    for some, least in ((np.arange(10), 0.9), (np.arange(100, 110), 0.0)):  # near copies, and vectors without any
        counts, score = {}, topk.exact(v, v[some])
        floors = np.array([np.sort(np.delete(score[:, k], q))[-20] for k, q in enumerate(some)], float)
        q, found, s = topk.search_block(v[some], some, floors, v, ids, pivots, counts=counts)
        for k, own in enumerate(some):
            other = np.flatnonzero(ids != own)
            assert found[q == k][np.lexsort((found[q == k], -s[q == k]))].tolist() == other[np.lexsort((other, -score[other, k]))][:20].tolist()
        assert 1 - counts["evaluated"] / counts["there"] >= least


# ------------------------------------------------------------------ 7


def test_licenses(spark, odd, docs):
    phrases = {p: licenses.words_of(p) for p in licenses.PHRASES}
    for df in (odd, docs):
        got = sorted((tuple(r) for r in licenses.summary(licenses.scan(df)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=repr)
        want = []
        for r in df.collect():
            words = licenses.words_of(r["text"] or "")
            at = [(k, licenses.PHRASES[p]) for p, w in phrases.items() for k in range(len(words)) if words[k : k + len(w)] == w]
            want.append((r["doc_id"], len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({label for _, label in at}))))
        assert got == sorted(want, key=repr)
    text = "header // Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [s["label"] for s in row["spans"]] == ["apache-2.0"] and row["spans"][0]["covered"] >= 15


def test_license_labels_need_more_than_ordinary_words():
    import pyarrow as pa

    scanner = licenses.Scanner(licenses.PHRASES, licenses.all_templates())
    found = lambda text: scanner(pa.array([text]))[0][2]
    for text in (
        "Both sides act under the terms of the agreement.", "He agreed to the terms of the offer.", "Entry is free provided that the following conditions are met.", "Please send a copy of this letter to any person obtaining a copy of this book.", "It is subject to the terms of the contract.",
        "You may not use this file.", "No part of this may be true.", "This work is licensed under a trade name, and all copies of the work are sold in the course of the year in the form of a book.",
    ):
        assert found(text) == [], text
    short = {"Released under the MIT License.": "mit", "Licensed under the Apache License": "apache-2.0", "Redistribution and use in source and binary forms": "bsd", "no part of this may be reproduced without permission": "reserved"}
    for text, label in short.items():
        assert [s.label for s in found(text)] == [label], text
    texts = licenses.all_templates()
    warranty = texts["mit"][1][texts["mit"][1].index("THE SOFTWARE IS") :]
    body = texts["gpl"][2][12000:14000]  # past the openings
    for text, label in ((warranty, "mit"), (body, "gpl"), (texts["bsd"][1][600:], "bsd"), (texts["mpl-2.0"][1], "mpl-2.0"), (texts["apache-2.0"][1][3000:6000], "apache-2.0")):
        assert {s.label for s in found("Some words first. " + text)} == {label}
    notice = licenses.TEMPLATES["mit"] + ". "
    assert [(s.label, s.first, s.share) for s in found(notice * 3)] == [("mit", 25 * k, 1.0) for k in range(3)]


def longest_run(words, template):
    """The length of the longest run of words that stands in the template."""
    best, row = 0, [0] * (len(template) + 1)
    for w in words:
        row = [0] + [row[k] + 1 if w == t else 0 for k, t in enumerate(template)]
        best = max(best, *row)
    return best


def test_license_spans_by_brute_force():
    """Every planted excerpt is found, every span is one, and skipping what no template has loses nothing."""
    import pyarrow as pa

    rng = np.random.default_rng(12)
    templates = {f"t{k}": " ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for k in range(4)}
    phrases = {"w1 w2": "p"}
    scanner = licenses.Scanner(phrases, templates, {"t0": [" ".join(templates["t0"].split()[:3])]})
    for _ in range(60):
        parts, planted = [], []
        for _ in range(rng.integers(1, 5)):
            parts += [f"x{x}" for x in rng.integers(0, 50, rng.integers(8, 40))] + [f"w{x}" for x in rng.integers(0, 400, rng.integers(0, 3))] + [f"x{x}" for x in range(8)]
            label, at, n = f"t{rng.integers(0, 4)}", int(rng.integers(0, 40)), int(rng.integers(3, 20))
            words = templates[label].split()[at : at + n]
            planted.append((label, len(parts), len(parts) + n - 1, n, at))
            parts += words
        n_words, places, spans = scanner(pa.array([" ".join(parts) + " y"]))[0]
        assert n_words == len(parts) + 1
        assert [w for _, w in places] == [k for k in range(len(parts) - 1) if parts[k : k + 2] == ["w1", "w2"]]
        found = {(s.label, s.first, s.last) for s in spans}
        for label, first, last, n, at in planted:
            marked = label == "t0" and at == 0 and n >= licenses.LEAST_COVERED
            if n >= licenses.LEAST_LONG or marked:
                assert any(a == label and f <= first and g >= last for a, f, g in found)
        for s in spans:
            assert s.covered >= licenses.LEAST_COVERED and longest_run(parts[s.first : s.last + 1], templates[s.label].split()) >= licenses.LEAST_RUN
            assert s.covered >= licenses.LEAST_LONG or s.covered >= licenses.LEAST_SHARE * 60 or s.label == "t0"
        coded, _ = scanner.words(*common.flat_utf8(pa.array([" ".join(parts) + " y"])))
        assert sorted(map(repr, scanner.spans(coded, 0))) == sorted(map(repr, spans))


def test_long_texts_and_empty_tables(spark, odd):
    """A megabyte in one row, and no row at all."""
    import pyarrow as pa

    rng = np.random.default_rng(14)
    words = [f"w{x}" for x in rng.integers(0, 30_000, 150_000)]
    text = " ".join(words)
    n_words, _, spans = licenses.Scanner(licenses.PHRASES, licenses.all_templates())(pa.array([text + " released under the MIT License."]))[0]
    assert n_words == len(words) + 5 and [s.label for s in spans] == ["mit"]
    first, second, sizes = jaccard.Shingler(3)(pa.array([text, None, text]))
    assert sizes.tolist() == [len({tuple(words[k : k + 3]) for k in range(len(words) - 2)})] * 1 + [0] + [sizes[0]]
    network = language.Network.fresh(["a", "b"])
    names, score = language.label_texts(network, pa.array([text, text[: language.WINDOW]]))
    assert names[0] in ("a", "b") and 0 < score[0] <= 1
    got = jaccard.near_groups(spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.select("doc_id", "component_id").collect()) == [(1, 1), (2, 1), (3, 3)]
    path = public_tokenizers.path
    assert licenses.scan(empty(odd)).count() == sentencepieces.encode_decode(empty(odd), path(sentencepieces.VOCABULARY)).count() == 0
    assert licenses.summary(licenses.scan(empty(odd))).count() == token_counts.count_tokens(empty(odd), path(token_counts.VOCABULARY)).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sequences = [rng.integers(0, 3, rng.integers(1, 12)).tolist() for _ in range(3)]
        automaton = licenses.SuffixAutomaton(sequences)
        text = rng.integers(0, 4, 30).tolist()
        runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for k, (length, state) in enumerate(automaton.statistics(text)):
            assert length == max((n for n in range(k + 2) if n == 0 or tuple(text[k + 1 - n : k + 1]) in runs), default=0)
            for number, at in automaton.places[state] if length else ():
                assert sequences[number][at - length + 1 : at + 1] == text[k + 1 - length : k + 1]


# ------------------------------------------------------------------ 9


def near_rows():
    """Groups of near copies, chains, and one group that shares most of its words."""
    rng = np.random.default_rng(9)
    rows = []
    for size in (1, 2, 3, 9, 18, 30, 60, 150, 400, 520, 1030, 2100):
        base = [f"w{rng.integers(0, 4000)}" for _ in range(size)]
        for copy in range(7):
            words = list(base)
            for _ in range(copy * max(1, size // 60) if size > 9 else copy % 2):
                words[rng.integers(0, size)] = f"v{rng.integers(0, 4000)}"
            rows.append(" ".join(words))
            base = words if copy % 3 == 2 else base
    return [(k * 3 % 1009, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
def test_jaccard(spark, odd, docs, size, num, monkeypatch):
    for limit, hot in ((jaccard.BROADCAST_ROWS, common.HOT_ROWS), (0, 2)):  # nothing broadcast, nearly every key dealt
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(common, "HOT_ROWS", hot)
        monkeypatch.setattr(jaccard, "FILTER_BITS", jaccard.FILTER_BITS if limit else 1 << 13)  # nearly all signatures pass
        rows = near_rows() + [(2000 + k, near_rows()[5][1]) for k in range(12)]
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1))
        got = jaccard.near_groups(df, size, num, 100).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=repr) == brute_components(rows, size, num, 100)
    want = brute_components(rows, size, num, 100)
    left = jaccard.drop_near_copies(df, size, num, 100)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, _, c in want if i == c)


def test_jaccard_of_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = jaccard.near_groups(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 3, 90, 100)
    assert jaccard.near_groups(empty(odd)).count() == jaccard.drop_near_copies(empty(odd)).count() == 0
    left = jaccard.drop_near_copies(odd)
    assert left.columns == odd.columns and left.where("doc_id IS NULL").count() == odd.where("doc_id IS NULL").count()


def thue_morse(n, swap=False):
    """n letters that polynomials modulo powers of two can't tell from their complement."""
    return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(n))


def test_jaccard_tells_structured_words_apart(spark):
    rows = [(k, thue_morse(n, swap)) for k, (n, swap) in enumerate((n, swap) for n in (16, 63, 64, 65, 256, 1024, 4096) for swap in (False, True))]
    rows += [(100, "\x01" * 8 + " " + "\x01" * 9), (101, "\x01" * 9 + " " + "\x01" * 8), (102, "a" * 8 + " b"), (103, "a" * 7 + " ab")]
    got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted((i, 1, i) for i, _ in rows)


def test_word_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(6)
    flat = rng.integers(0, 3, 4000).astype(np.uint8)
    start = rng.integers(0, 3900, 3000)
    end = start + rng.integers(1, 100, 3000)
    first, second = common.word_hashes(flat, start, end)
    seen = {}
    for a, b, x, y in zip(start, end, first.tolist(), second.tolist()):
        assert seen.setdefault(flat[a:b].tobytes(), (x, y)) == (x, y)
    assert len(set(seen.values())) == len(seen) and len({x for x, _ in seen.values()}) == len({y for _, y in seen.values()}) == len(seen)


def test_wide_sketches_differ_in_no_more_bits_than_sets_do(spark):
    rng = np.random.default_rng(4)
    sign, pairs = jaccard.Signer(80, 100), []
    for size in (1, 500, 512, 513, 1000, 1024, 1025, 1200, 5000):
        for larger in (size, int(size * 1.02) + 1, int(size * 1.2)):
            pairs += [(rng.integers(0, 1 << 62, size).astype(np.uint64), None, larger)]
    rows = []
    for k, (a, _, larger) in enumerate(pairs):
        for changed in (0, 3, len(a) // 9, len(a)):
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 62, larger - len(a) + changed).astype(np.uint64)]))
            code, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
            x, y = sign.wide_sketches(code, sizes).to_pylist()
            assert all(len(w) == 0 if n <= 512 else len(w) * 64 >= n for w, n in zip((x, y), sizes))
            common = len(np.intersect1d(a, b))
            rows.append((k, x, y, len(a), len(b), 100 * common >= 80 * (len(a) + len(b) - common), common == 0))
    df = spark.createDataFrame(rows, "k int, xw array<long>, yw array<long>, xn int, yn int, link boolean, apart boolean")
    df = df.select("link", "apart", F.struct(F.col("xw").alias("wide"), F.col("xn").alias("n")).alias("x"), F.struct(F.col("yw").alias("wide"), F.col("yn").alias("n")).alias("y"))
    got = df.select("link", "apart", "x.n", jaccard._may_link_wide("x", "y", 80, 100).alias("may")).collect()
    assert all(r["may"] for r in got if r["link"]) and any(r["link"] for r in got)
    assert not any(r["may"] for r in got if r["apart"] and r["n"] > 1025)


def test_allocation_holds_the_pigeonhole():
    for num in (80, 90):
        for upper in range(1, 3000, 7):
            segments, deletions, spare = jaccard.allocate(max(1, upper * 4 // 5), upper, num, 100)
            larger = upper * 100 // num
            assert segments - spare + deletions >= min(1, segments) * ((100 - num) * (upper + larger) // (100 + num) + 1)
            assert not (spare and deletions)
