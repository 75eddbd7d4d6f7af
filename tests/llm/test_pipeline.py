"""The pipeline against its stages, each done again by brute force."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from lakegate.llm import mixing, packing, quality
from tests.llm.test_minhash import by_hand, shingles
from lakegate.llm.minhash import Settings

SF_DIR = Path("/root/testdata/sf0.001")


def test_stages_equal_brute_force(spark, tmp_path):
    if not SF_DIR.exists():
        pytest.skip("test tables are absent")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    rows, kept = {0: docs.collect()}, docs
    for k, (_, step) in enumerate(corpus_pipeline.STAGES, 1):
        out = str(tmp_path / str(k))
        step(spark, kept, str(SF_DIR)).write.parquet(out)
        kept = spark.read.parquet(out)
        rows[k] = kept.collect()
        if k < len(corpus_pipeline.STAGES):
            assert kept.columns == columns

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels)
    x = np.array([quality.features((r.text or "").encode()) for r in rows[0]])
    good = {r.doc_id for r, score in zip(rows[0], model.score(x)) if score >= quality.KEEP}
    assert {r.doc_id for r in rows[1]} == good

    groups = {}
    for r in rows[1]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    assert {r.doc_id for r in rows[2]} == {min(g)[1] for g in groups.values()}

    homes = by_hand([(r.doc_id, r.text) for r in rows[2]], Settings())
    assert {r.doc_id for r in rows[3]} == {i for i, (_, home) in homes.items() if i == home}

    # All documents are in the mix at their sources' own weights, in the order of its slots.
    assert sorted(r.doc_id for r in rows[4]) == sorted(r.doc_id for r in rows[3])
    source = [r.source for r in rows[4]]
    most = max(set(source), key=source.count)
    half = source[: len(source) // 2].count(most)
    assert abs(half - source.count(most) / 2) <= 2 * mixing.BLOCK_ROWS

    words = packing.words(packing.VOCABULARY)
    found = {}
    for p in sorted(rows[5], key=lambda p: (p.doc_id, p.start)):
        found[p.doc_id] = found.get(p.doc_id, b"") + p.ids
    end = np.uint32(packing.END).tobytes()
    assert found == {r.doc_id: words.ids((r.text or "").encode()) + end for r in rows[4]}

    again = corpus_pipeline.run(spark, str(SF_DIR)).collect()
    assert sorted((p.doc_id, p.start, p.ids) for p in again) == sorted((p.doc_id, p.start, p.ids) for p in rows[5])


@pytest.mark.parametrize("empty", [False, True], ids=["odd rows", "empty tables"])
def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path, empty):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [
        (1, "a b c d e f g", "en", "s", 13),
        (1, "a b c d e f g", "en", "s", 13),
        (None, "a b c d e f g", None, None, None),
        (2, None, "en", "s", None),
        (3, "", None, None, 0),
        (4, long, "en", "t", None),
        (5, long + " end", "en", "t", None),
        (6, "\U0001f600" * 10_000, "en", "t", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([] if empty else rows, schema)
    labels = spark.createDataFrame([(None, None, None), (1, 1, 0)][: 0 if empty else 2], "doc_id long, quality int, toxic int")
    for name, frame in (("documents", docs), ("labels", labels)):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    kept, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, kept, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(kept.count())
    if empty:
        assert sizes == [0] * 5
    else:
        # One good label: nothing speaks against a text. Copies of 1, and the null text beside the
        # empty one, go as exact copies; 5 goes as a near copy of 4.
        assert sizes[:3] == [8, 5, 4]
        assert {r.doc_id for r in kept.select("doc_id").distinct().collect()} == {1, 2, 4, 6}


def test_shingles_helper():
    assert shingles("a B c", 2) == {(b"a", b"b"), (b"b", b"c")}


def test_the_mix_decides_the_order_of_sequences(spark, tmp_path):
    """Documents of many files, the largest file not the first: sequence ids follow the slots of the mix."""
    rows = [(i, " ".join(["word"] * (1 + i % 5 * 300)), "en", "ab"[i % 3 == 0], 0) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    slot = {r.doc_id: r.slot for r in mixing.schedule(docs).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus_pipeline.source_mix(spark, docs, "").write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "mixed").glob("part-*"))) > 2
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    pieces = corpus_pipeline.packed(spark, mixed, "").select("doc_id", "start", "sequence_id").collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    order = [(p.doc_id, p.start) for p in sorted(pieces, key=lambda p: p.sequence_id)]
    assert [slot[i] for i, _ in order] == sorted(slot[i] for i, _ in order)
    assert all(a[0] != b[0] or a[1] < b[1] for a, b in zip(order, order[1:]))
    assert sorted(r.place for r in mixing.with_place(mixed).collect()) == list(range(900))
