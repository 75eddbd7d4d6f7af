"""Quality classifier: held-out accuracy, and its parts against plain definitions."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from lakegate.llm import quality

SF_DIR = Path("/root/testdata/sf0.01")


def test_features_are_defined_for_any_text():
    for text in (b"", b" \n", b"a", "é́\U0001f600".encode(), b"x" * 500_000, b"\n\n##$$ A A A"):
        row = quality.features(text)
        assert len(row) == len(quality.FEATURES) and np.isfinite(row).all()
    row = dict(zip(quality.FEATURES, quality.features(b"THE the the.\nTHE the the.")))
    assert row["repeated_lines"] == 0.5 and row["upper_words"] == 2 / 6 and row["distinct_words"] == 0.5


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, pairs=2)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.95


def test_score_is_a_sum_of_bins():
    rng = np.random.default_rng(1)
    x = rng.random((300, 2))
    model = quality.fit(x, (x.sum(axis=1) > 1).astype(float), pairs=1)
    for row in x[:20]:
        total = model.intercept
        for i, (edges, values) in enumerate(zip(model.edges, model.tables)):
            total += values[sum(row[i] >= e for e in edges)]
        for (i, j), values in zip(model.pairs, model.pair_tables):
            total += values[sum(row[i] >= e for e in model.coarse[i]), sum(row[j] >= e for e in model.coarse[j])]
        assert np.isclose(model.score(row[None])[0], 1 / (1 + np.exp(-total)))


def test_one_class_or_no_labels():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((1, 3)))[0] > 0.9
    assert quality.fit(np.zeros((9, 3)), np.zeros(9)).score(np.zeros((1, 3)))[0] < 0.2


def test_query_on_held_out_labels(spark):
    if not SF_DIR.exists():
        pytest.skip("test tables are absent")
    rows = quality.op7_quality(spark, str(SF_DIR)).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(rows) == docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rng = random.Random(0)
    docs = spark.createDataFrame([(i, "good text here " * rng.randrange(1, 9)) for i in range(80)], "doc_id long, text string")
    labels = [(i, i % 2, 0) for i in range(80)] + [(None, 1, 0), (3, None, 0)]
    turned = [(i, (q if i is None or zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q), t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    first = quality.train(docs, spark.createDataFrame(labels, schema))
    second = quality.train(docs, spark.createDataFrame(turned, schema))
    assert all(np.array_equal(a, b) for a, b in zip(first.tables, second.tables))


def test_accepted_keeps_columns_and_handles_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 2.0, "a"), (1, "", 2.0, None), (None, "t", None, "b")], "doc_id long, text string, score double, row string")
    model = quality.fit(np.zeros((0, 16)), np.zeros(0))
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    assert quality.scored(docs.limit(0), model).collect() == []


def test_repeated_rows_and_clashing_columns_give_one_model(spark):
    """However rows repeat and are dealt, every labelled id counts once for each of its labels."""
    rng = random.Random(5)
    texts = [(i % 300, "word " * rng.randrange(1, 40) + rng.choice(("end.", "END")), 0, "x") for i in range(900)]
    labels = [(i, int(i % 3 > 0)) for i in range(300)] * 3
    tables = set()
    for parts in (1, 5):
        rng.shuffle(texts)
        docs = spark.createDataFrame(texts, "doc_id long, text string, label int, _id string").repartition(parts)
        known = spark.createDataFrame(labels, "doc_id int, quality int").repartition(parts)
        model = quality.train(docs, known, sample_rows=150)
        tables.add(b"".join(t.tobytes() for t in model.tables) + np.float64(model.intercept).tobytes())
    assert len(tables) == 1
