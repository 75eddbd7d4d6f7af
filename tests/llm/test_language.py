"""Language identification: Viterbi against all paths, held-out accuracy, mixed texts."""

from __future__ import annotations

from itertools import product
from pathlib import Path

import numpy as np
import pytest

from lakegate.llm import language

SF_DIR = Path("/root/testdata/sf0.01")


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    scores = np.concatenate((np.zeros((1, 3)), rng.normal(size=(9, 3)) * 3)).astype(np.float32)
    texts = [rng.integers(1, 10, n) for n in (0, 1, 6, 3, 5, 6)]
    for switch in (0.5, 2.0, 50.0):
        for rows, path in zip(texts, language.viterbi(texts, scores, switch)):

            def value(labels):
                own = sum(scores[r, k] for r, k in zip(rows, labels))
                return own - switch * sum(a != b for a, b in zip(labels, labels[1:]))

            best = max((value(p) for p in product(range(3), repeat=len(rows))), default=0)
            assert len(path) == len(rows) and np.isclose(value(path.tolist()), best, atol=1e-4)


def model_docs(spark):
    english = "the quick brown fox jumps over the lazy dog and then they walk through that thick wood with them"
    german = "der schnelle braune fuchs springt über den faulen hund und dann gehen sie durch den dichten wald"
    russian = "быстрая коричневая лиса прыгает через ленивую собаку и потом они идут через густой лес"
    rows = [(i, text, lang, "s") for i, (text, lang) in enumerate(((english, "en"), (german, "de"), (russian, "ru")) * 20)]
    rows += [(900, english, None, "s"), (901, None, "en", "s"), (902, "123", "xx", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), english, german, russian


def test_spans_of_mixed_texts(spark):
    docs, english, german, russian = model_docs(spark)
    model = language.train(docs)
    assert set(model.languages) >= {"de", "en", "ru"}
    rows = [(1, f"{german}. {german}! {english}"), (2, russian), (3, None), (4, "12 !? ²"), (5, ""), (None, english), (5, english)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    mixed = found[0]
    assert mixed.lang_pred == "de" and [s.lang for s in mixed.spans] == ["de", "en"] and 0.5 < mixed.score < 0.8
    assert mixed.spans[0].end_word == mixed.spans[1].first_word == 34
    assert [r.lang_pred for r in found[1:]] == ["ru", "und", "und", "und", "en", "en"]
    assert all(r.score == 0 and not r.spans for r in found[2:5])
    assert language.identify(docs.limit(0), model).collect() == []


def test_without_labels_everything_is_undetermined(spark):
    docs = model_docs(spark)[0].withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(docs, language.train(docs)).collect()} == {"und"}


def test_long_text_is_one_text(spark):
    docs, english, german, _ = model_docs(spark)
    text = f"{english} " * 3000 + german
    found = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), language.train(docs)).first()
    assert found.lang_pred == "en" and [s.lang for s in found.spans] == ["en", "de"]


def test_query_on_held_out_documents(spark):
    if not SF_DIR.exists():
        pytest.skip("test tables are absent")
    rows = language.op10_language(spark, str(SF_DIR)).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_a_rare_language_is_learned_beside_a_common_one(spark):
    common = "the quick brown fox jumps over the lazy dog and then they walk through that thick wood"
    rare = "kaj nun la rapida vulpo saltas trans la mallaborema hundo kaj poste ili iras tra densa arbaro"
    ids = [i for i in range(2000) if i % 400 != 7]
    rows = [(i, common, "en") for i in ids] + [(i, rare, "eo") for i in (2001, 2002, 2003, 2004, 2005)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, sample_rows=3)
    assert model.languages == ["en", "eo"]
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert found[2001] == "eo" and found[0] == "en"


def test_all_letters_of_a_word_narrow_its_languages():
    scripts = np.zeros((len(language.SCRIPT_NAMES), 3), bool)
    names = language.SCRIPT_NAMES
    latin, cyrillic = names.index("Latin"), names.index("Cyrillic")
    scripts[latin] = [True, False, True]
    scripts[cyrillic] = [False, True, True]
    grams = np.zeros((language.BUCKETS, 3))
    known = language._WordScores(language.Model(["a", "b", "c"], grams, scripts))
    (rows,) = known.numbers([["abc", "где", "abгд", "γδ"]])
    best = [set(np.flatnonzero(known.scores[r] == 0)) for r in rows]
    assert best == [{0, 2}, {1, 2}, {2}, {0, 1, 2}]
