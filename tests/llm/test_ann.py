"""Nearest neighbours: recall and scores against brute force, probing against all codes."""

from __future__ import annotations

import numpy as np

from lakegate.llm import ann


def brute(ids, x, query_ids, k):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        scores = unit @ unit[list(ids).index(q)]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def ann_usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 16, (500, ann.BITS // 16), dtype=np.uint16)
    codes[100:120] = codes[7]
    index = ann.MultiIndex(codes)
    bits = np.unpackbits(codes.view(np.uint8), axis=1)
    for radius in (0, 40, 100, 120, 130):
        expected = np.flatnonzero((bits != bits[7]).sum(axis=1) <= radius)
        assert np.array_equal(index.within(codes[7], radius), expected)


def test_reaches_leave_no_code_out_and_prefer_short_lists():
    rng = np.random.default_rng(2)
    held = np.sort(rng.integers(0, 50, (4, ann.SUBSTRING_BITS + 1)), axis=1) + 1.0
    held[1] *= 100  # an index whose entries are dear
    for radius in (0, 2, 3, 9, 20, 64):
        reach = ann.MultiIndex.reaches(held, radius)
        assert (reach + 1).sum() == radius + 1
        assert (reach <= ann.SUBSTRING_BITS).all()
    assert ann.MultiIndex.reaches(held, 20)[1] < ann.MultiIndex.reaches(held, 20)[[0, 2, 3]].min()


def test_probing_reads_less_than_all():
    """Clustered vectors: the codes near a query are few, and so are the rows that are read."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 64))
    x = np.repeat(centres, 50, axis=0) + 0.15 * rng.standard_normal((3000, 64))
    model = ann.fit(x, 5)
    codes = model.codes(x)
    index = ann.MultiIndex(codes)
    share = np.mean([len(index.visited(codes[i], model.radius)) / len(x) for i in range(0, 3000, 100)])
    assert share < 0.2


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [r for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if ann_usable(r.embedding)]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    truth = brute(ids, x, [int(i) for i in ids if i % 50 == 0], 5)
    got = {}
    for r in ann.op6_ann(spark, folder).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(truth)
    hits = 0
    for q, near in got.items():
        assert sorted(near) == list(range(1, min(5, len(rows) - 1) + 1))
        ordered = [near[i] for i in sorted(near)]
        assert ordered == sorted(ordered, key=lambda p: (-p[1], p[0]))
        hits += len({v for v, _ in ordered} & {v for v, _ in truth[q]})
    assert hits >= 0.9 * sum(map(len, truth.values()))


def test_recall_order_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "DATA_BLOCK", 300)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # queries arrive in many batches
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 32)).astype(np.float32).astype(float)
    x[200:260] = x[50]  # one vector many times
    rows = [(i, [float(v) for v in x[i]], i) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    try:
        found = ann.search(frame, frame.where("vec_id % 50 = 0")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    truth = brute(np.arange(1500), x, range(0, 1500, 50), 5)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(truth)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in truth[q]}) for q in truth)
    assert hits >= 0.95 * 5 * len(truth)
    assert [v for v, _ in got[50]] == [200, 201, 202, 203, 204]
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (-p[1], p[0])) and len(near) == 5
        for v, score in near:
            cosine = x[q] @ x[v] / np.linalg.norm(x[q]) / np.linalg.norm(x[v])
            assert abs(score - cosine) < 1e-12


def test_unusable_vectors_few_rows_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (50, [0.0, 2.0]), (1, [0.5, 0.5]), (100, []),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.search(frame, frame.where("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [
        (0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0),
    ]
    assert ann.search(frame.limit(0), frame.limit(0)).collect() == []
