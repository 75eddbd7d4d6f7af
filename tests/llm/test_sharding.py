"""Sharding: balance, gapless slots, and the ring walked row by row."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

from lakegate.llm import sharding


def docs(spark, n, text="t"):
    rows = [(i, None if i % 7 == 0 else text * (i % 5), i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, slot long").repartition(5)


def check(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_balance_at_many_sizes(spark):
    for n in (0, 1, 7, 8, 9, 500):
        check(sharding.shard(docs(spark, n)).collect(), 8)


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a")] * 30 + [(5, "b")] * 70 + [(6, None)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()
    check(found, 3)
    assert len(found) == 101


def test_place_walks_the_ring_like_rows_one_by_one():
    nodes = sharding.virtual_nodes(4, 3)
    counts = {arc: (arc * 37) % 11 for arc in range(len(nodes))}
    total = sum(counts.values())
    room = [total // 4 + (s < total % 4) for s in range(4)]
    expected = Counter()
    waiting = []
    for arc, (_, s) in enumerate(nodes):
        for _ in range(counts[arc]):
            if room[s]:
                room[s] -= 1
                expected[arc, s] += 1
            else:
                waiting.append(arc)
    for arc in waiting:
        step = next(k for k in range(1, len(nodes)) if room[nodes[(arc + k) % len(nodes)][1]])
        s = nodes[(arc + step) % len(nodes)][1]
        room[s] -= 1
        expected[arc, s] += 1
    found = Counter()
    for share in sharding.place(nodes, counts, 4):
        found[share.arc, share.shard] += share.end - share.first
    assert found == expected


def test_one_more_shard_moves_few_rows(spark):
    frame = docs(spark, 4000)
    before = {r.doc_id: r["shard"] for r in sharding.shard(frame, 8).collect()}
    after = {r.doc_id: r["shard"] for r in sharding.shard(frame, 9).collect()}
    assert sum(before[i] != after[i] for i in before) < 0.2 * len(before)


def test_cells_and_query(spark, tmp_path):
    docs(spark, 50).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.op5_sharding(spark, str(tmp_path)).collect()
    check(rows, 8)
    for r in rows:
        text = "" if r.doc_id % 7 == 0 else "t" * (r.doc_id % 5)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text.encode()), "rows", None)
    cells = sharding.shard(docs(spark, 50)).collect()
    assert all(r.cell == int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:4], 16) for r in cells)


def test_plan_has_no_python(spark):
    plan = sharding.shard(docs(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
