"""Phrases: counts and ranks against a plain count in Python integers; the tries; odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegate.llm import collocations as op


def brute(rows, settings):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            own = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            totals[lang] += len(own)
            for m in range(1, settings.longest + 1):
                counts.update((lang, own[i : i + m]) for i in range(len(own) - m + 1))
    frequent = {k: f for k, f in counts.items() if f >= settings.least and len(k[1]) > 1}
    gone = set()
    for (lang, phrase), f in frequent.items():
        for m in range(2, len(phrase)):
            for i in range(len(phrase) - m + 1):
                if frequent.get((lang, phrase[i : i + m])) == f:
                    gone.add((lang, phrase[i : i + m]))
    out = []
    for (lang, phrase), a in frequent.items():
        if (lang, phrase) in gone:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]  # noqa: E741
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        out.append((lang, -score, -a, " ".join(phrase).encode(), l, r, totals[lang]))
    ranks, rows = Counter(), []
    for lang, score, a, phrase, l, r, n in sorted(out):  # noqa: E741
        ranks[lang] += 1
        if ranks[lang] <= settings.top:
            rows.append((lang, ranks[lang], phrase.decode(), -a, l, r, n, -score))
    return rows


def texts(count, seed=2):
    rng = random.Random(seed)
    common = ["the", "of", "Ünder", "a\x00b", "x" * 30, "和"] + [f"w{i}" for i in range(10)]
    fixed = ["new york city", "ad hoc", "one two three four five six"]
    rows = []
    for i in range(count):
        body = [rng.choice(fixed if rng.random() < 0.2 else common) for _ in range(rng.randrange(50))]
        joined = "".join(w + rng.choice([" ", " ", "\t ", ", ", ".\n", "  "]) for w in body)
        rows.append((joined.upper() if i % 7 == 0 else joined, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (" .,; ", None), ("the " * 4000, "en")]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_a_plain_count(spark, monkeypatch, small):
    settings = op.Settings(least=12, top=40)
    if small:  # many tries, many blocks, early hand-over
        monkeypatch.setattr(op, "TRIE_PHRASES", 50)
        monkeypatch.setattr(op, "BLOCK", 8)
        monkeypatch.setattr(op, "SUMMED", 2)
        monkeypatch.setattr(op, "HELD", 10)
    rows = texts(150)
    docs = spark.createDataFrame([(t, lang, 1) for t, lang in rows], "text string, lang string, n int").repartition(5)
    found = [tuple(r) for r in op.collocations(docs, settings).orderBy("lang", "rank").collect()]
    assert found == brute(rows, settings)
    assert any(len(r[2].split(" ")) == 5 for r in found)


def test_no_documents_and_no_phrases(spark):
    docs = spark.createDataFrame([("a b c", "en"), (None, None)], "text string, lang string")
    assert op.collocations(docs).collect() == []
    assert op.collocations(docs.limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    values = [(10**13 + 7, 10**12 + 3, 10**12 + 9, 10**14 + 1), (100, 100, 100, 10**16), (3, 10**15, 10**15, 7)]
    frame = spark.createDataFrame(values, "a long, l long, r long, n long")
    found = [r.s for r in frame.select(op._score("a", "l", "r", "n").alias("s")).collect()]
    assert found == [1000 * a * n // (l * r) for a, l, r, n in values]


@pytest.mark.parametrize("words", [3, 300, 70_000])
def test_trie_finds_its_phrases_only(words):
    rng = np.random.default_rng(words)
    numbers = rng.integers(0, 2**63, words).astype(np.uint64)
    phrases = {tuple(rng.choice(numbers, rng.integers(1, 5))) for _ in range(4000)}
    phrases |= {(int(numbers[0]), int(n)) for n in numbers[:2000]}  # one node with very many children
    listed = [np.array(p, np.uint64) for p in sorted(phrases)]
    trie = op.Trie.unpacked(op.Trie.of(listed).packed())
    for i in [*range(0, len(listed), 37), len(listed) - 1]:
        state, on = np.zeros(1, np.int64), np.ones(1, bool)
        for number in listed[i]:
            state, on = trie.advance(state, trie.codes(np.array([number], np.uint64)))
            assert on.all()
        assert trie.accept[state[0]] == i
    absent = rng.integers(0, 2**63, 500).astype(np.uint64)
    assert not trie.codes(absent).any()
    # From any state, a word leads on only if the longer phrase has a node.
    beginnings = {p[:k] for p in map(tuple, listed) for k in range(1, 6)}
    probes = rng.choice(numbers, (300, 2))
    first, on = trie.advance(np.zeros(300, np.int64), trie.codes(probes[:, 0]))
    _, both = trie.advance(first, trie.codes(probes[:, 1]))
    assert [bool(b and o) for b, o in zip(both, on)] == [tuple(p) in beginnings for p in probes]


def test_two_words_with_one_hash_take_another_seed(spark, monkeypatch):
    original = op._word_hasher

    def colliding(seed):
        def add(batches):
            for batch in original(seed)(batches):
                if seed == 0:
                    key = op.pa.array([b"12345678"] * batch.num_rows, op.pa.binary())
                    batch = batch.set_column(batch.schema.get_field_index("key"), "key", key)
                yield batch

        return add

    monkeypatch.setattr(op, "_word_hasher", colliding)
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    _, frequent, seed = op._vocabulary(docs, op.Settings(least=1))
    assert seed == 1 and frequent.select(F.countDistinct("key")).first()[0] == 2
