"""Whitening against numpy over the distinct vectors, with exact sums in Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegate.llm import whitening as op


def whole(vector, scale=64, shift=1_000_000):
    return tuple(math.floor(scale * float(c)) + shift for c in vector)


def check(rows, usable, found, weigh="one", components=16):
    xs = {}
    for _, vector in usable:
        xs[whole(vector)] = xs.get(whole(vector), 0) + 1
    keys = list(xs)
    weights = [xs[k] if weigh == "counts" else 1 for k in keys]
    n = sum(weights)
    sums = [sum(w * k[i] for k, w in zip(keys, weights)) for i in range(len(keys[0]))]
    centred = np.array([[float(a - s // n) - (s % n) / n for a, s in zip(k, sums)] for k in keys])
    covariance = (centred * np.array(weights)[:, None]).T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    assert len(found) == len(usable)
    expected = {k: (sum((n * a - s) ** 2 for a, s in zip(k, sums)), c) for k, c, in zip(keys, centred)}
    given = {}
    for vec_id, vector in usable:
        given.setdefault(vec_id, []).append(whole(vector))
    sign = None
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        match = [k for k in given[r.vec_id] if expected[k][0] == r.deviation]
        assert match
        wanted = expected[match[0]][1] @ vectors[:, order] / np.sqrt(values[order])
        got = np.array(r.whitened)
        assert np.allclose(np.abs(got), np.abs(wanted), atol=1e-7)
        own = np.sign(got) * np.sign(wanted)
        sign = own if sign is None else sign
        assert ((own == sign) | (np.abs(got) < 1e-9)).all()
        assert np.allclose(r.explained, values[order] / np.trace(covariance), rtol=1e-6)


@pytest.mark.parametrize("weigh", ["one", "counts"])
def test_rows_against_numpy(spark, monkeypatch, weigh):
    monkeypatch.setattr(op, "_ROWS", 37)
    monkeypatch.setattr(op, "_HOT_SHARE", 8)
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((300, 6)) * [9, 7, 5, 3, 2, 1] + 2).astype(np.float32).astype(float)
    x[100:200] = x[7]  # one vector many times
    rows = [(i, [float(c) for c in x[i]]) for i in range(300)] + [(5, [float(c) for c in x[9]]), (None, [0.5] * 6)]
    nan = float("nan")
    odd = [(400, None), (401, [nan] * 6), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("inf")] * 6),
           (404, []), (405, [1.0]), (406, [1e300] * 6)]
    table = [(i, v, 1) for i, v in rows + odd]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<float>, x int").repartition(3)
    if weigh == "one":
        frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, x int").repartition(3)
    found = op.whiten(frame, op.Settings(weigh=weigh, components=4)).collect()
    check(rows, rows, found, weigh, components=4)


def test_query_over_a_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = op.op13_whitening(spark, sf_dir).collect()
    assert len(found) == 16 * len(rows)
    assert {r.component for r in found} == set(range(1, 17))
    check(rows, rows, op.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).collect())


def test_large_deviations_stay_exact_or_null(spark):
    rows = [(i, [float(1 << 20) * (i % 2), 1.0 * i]) for i in range(8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(rows, rows, op.whiten(frame).collect())
    vast = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0**45, 0.0])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in op.whiten(vast).collect()] == [None, None]


def test_nothing_to_whiten(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [(r.n, r.deviation, r.whitened) for r in op.whiten(frame).collect()] == [(1, 0, []), (1, 0, [])]
    assert op.whiten(frame.limit(0)).collect() == []
    assert op.whiten(frame.select("vec_id", F.lit(None).cast("array<double>").alias("embedding"))).collect() == []
