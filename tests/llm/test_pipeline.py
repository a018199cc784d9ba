"""Every stage of the corpus pipeline against a plain version, on what the stage before kept."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute import chain_probabilities, language_probabilities

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from shelfwise.llm import language, packing, toxicity  # noqa: E402


def stay_toxicity(spark, sf_dir, docs, rows):
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return [r for r in rows if chain_probabilities(chain, r["text"] or "")[1] < 0.5]


def stay_language_id(spark, sf_dir, docs, rows):
    network = language.train(docs)
    return [r for r in rows if re.search(r"[^\W\d_]", r["text"] or "") and language_probabilities(network, r["text"].encode()).max() >= 0.35]


def stay_exact_dedup(spark, sf_dir, docs, rows):
    last = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        last[r["text"] or ""] = r
    return list(last.values())


def stay_ngram_jaccard(spark, sf_dir, docs, rows):
    sets = {}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links, ids = defaultdict(set), sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    gone = set()
    for a in ids:  # all that can be reached from a smaller id
        queue = [a] if a not in gone else []
        while queue:
            for b in links[queue.pop()] - gone - {a}:
                gone.add(b)
                queue.append(b)
    return [r for r in rows if r["doc_id"] not in gone]


def check_packing(rows, pieces):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows}
    ends, room = defaultdict(int), defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert p["start"] == ends[p["doc_id"]] and p["doc_tokens"] == len(ids[p["doc_id"]])
        ends[p["doc_id"]] += p["length"]
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]
        room[p["sequence_id"]].append((p["offset"], p["length"]))
    assert ends == {k: len(v) for k, v in ids.items()}
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_equal_plain_versions(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "exact_dedup", "ngram_jaccard", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs, rows = docs, spark.read.parquet(str(tmp_path / name)), docs.collect()
        if name == "packing":
            check_packing(rows, docs.collect())
        else:
            want = globals()[f"stay_{name}"](spark, sf_dir, before, rows)
            assert docs.columns == before.columns and sorted(map(tuple, docs.collect()), key=repr) == sorted(map(tuple, want), key=repr), name


def test_stages_take_empty_tables_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (1, "", "en", "s", 0), (None, "some words here", "en", None, 3), (2, "some words here", None, "s", 3), (2, "some words here", None, "s", 3), (3, "word " * 20_000, "en", "s", 9)], docs.schema)
    learned = {"toxicity": lambda d: toxicity.train(d, spark.read.parquet(f"{sf_dir}/labels.parquet")), "language_id": language.train}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf_dir).count() == 0, name
        kept = stage(spark, odd, sf_dir)
        rows = sorted(kept.collect(), key=repr)
        if name == "packing":
            total, whole = defaultdict(int), {}
            for r in rows:  # documents may be cut anywhere
                total[r["doc_id"]] += r["length"]
                whole[r["doc_id"]] = r["doc_tokens"]
            assert total == {1: 2, None: whole[None], 2: 2 * whole[None], 3: whole[3]} and whole[1] == 1 and whole[3] > 20_000
            continue
        assert kept.columns == docs.columns
        by_text = {"toxicity": [None, "", "some words here", "some words here", "some words here", "word " * 20_000], "exact_dedup": ["", "some words here", "word " * 20_000]}
        texts = sorted((r["text"] or "" for r in rows), key=len)
        if name == "toxicity":  # trained on no label among these ids, or on few: a text's fate is that of its probability
            chain = learned[name](odd)
            assert texts == sorted((t or "" for t in by_text[name] if chain([t or ""])[0][1] < 0.5), key=len)
        elif name == "language_id":
            network = learned[name](odd)
            assert texts == sorted((r["text"] for r in odd.collect() if network.languages and re.search(r"[^\W\d_]", r["text"] or "") and language_probabilities(network, r["text"].encode()).max() >= 0.35), key=len)
        elif name == "exact_dedup":
            assert texts == by_text[name] and [r["doc_id"] for r in rows if r["text"] == "some words here"] == [2]
        else:  # the ids that stay: 1 twice, none, 2 twice and 3
            assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 1, 2, 2, 3]


def test_run_gives_the_last_stage(spark, sf_dir):
    assert {"doc_id", "sequence_id", "ids_crc32"} <= set(corpus_pipeline.run(spark, sf_dir).columns)
