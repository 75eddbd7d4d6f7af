"""Mixing: the schedule against its own laws, checked slot by slot."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from lakegate.llm import mixing


@pytest.mark.parametrize("share", [[1], [1, 1], [3, 5, 8], [1, 1, 1, 61], [7, 11, 13, 33, 64]])
def test_period_meets_windows_and_deviates_less_than_a_block(share):
    period, slots = sum(share), mixing.one_period(share)
    assert sorted(s for own in slots for s in own) == list(range(period))
    for q, own in zip(share, slots):
        assert len(own) == q
        for j, slot in enumerate(own):
            assert j * period // q <= slot < -(-(j + 1) * period // q)
        for t in range(period + 1):
            assert abs(sum(s < t for s in own) - t * q / period) < 1


def test_units_and_caps():
    assert sum(mixing.units([0.5, 0.3, 0.2], 1000)) == 1000
    assert min(mixing.units([1e-9, 1.0], 1000)) == 1
    weights, over = mixing.capped([900, 50, 50], 1 / 3)
    assert over[0] and math.isclose(weights[0], 1 / 3) and math.isclose(sum(weights), 1)
    assert mixing.capped([10], 1 / 3) == ([1.0], [False])
    assert mixing.capped([5, 5], 0.1)[1] == [False, False]


def docs(spark, sizes, extra=()):
    rows = [(s, i) for s, n in sizes for i in range(n)]
    frame = [(k, s, "t") for k, (s, _) in enumerate(rows)] + list(extra)
    return spark.createDataFrame(frame, "doc_id long, source string, slot string")


def test_hot_source_is_cut_to_its_target_and_the_rest_stays_whole(spark):
    frame = docs(spark, [("hot", 4000), ("a", 700), ("b", 500), (None, 300)])
    rows = mixing.schedule(frame, max_share=1 / 3, block_rows=4).collect()
    assert len(rows) == 5500
    mixed = Counter(r.source for r in rows if r.in_mix)
    assert (mixed["a"], mixed["b"], mixed[""]) == (700, 500, 300)
    assert abs(mixed["hot"] - 750) <= 8
    blocks = Counter((r.source, r.block) for r in rows)
    assert max(blocks.values()) == 4
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert len({(r.slot) for r in rows}) == len(blocks)


def test_given_weights_hold_at_every_slot(spark):
    target = {"a": 0.5, "b": 0.3, "c": 0.2}
    frame = docs(spark, [("a", 400), ("b", 500), ("c", 300), ("unnamed", 50)])
    rows = mixing.schedule(frame, target, block_rows=2).collect()
    slots = sorted({(r.slot, r.source) for r in rows if r.in_mix})
    assert [s for s, _ in slots] == list(range(len(slots)))
    seen = Counter()
    for at, (_, source) in enumerate(slots, 1):
        seen[source] += 1
        assert all(abs(seen[s] - at * w) < 1.01 for s, w in target.items())
    assert all(r.slot is None and not r.in_mix for r in rows if r.source == "unnamed")
    assert mixing.mix(frame, target).columns == frame.columns


def test_empty_repeated_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.schedule(empty).collect() == []
    same = docs(spark, [("a", 3)], [(None, "a", "t"), (0, "a", "t"), (0, "a", "t")])
    assert mixing.schedule(same).count() == 6 and mixing.mix(same).count() == 6


def test_more_sources_than_any_cap_have_windows_of_their_own(spark):
    """Less than one block of deviation for each of 5,000 sources, at every slot."""
    tail = [(f"site{i}", 1 + i % 7) for i in range(5000)]
    frame = docs(spark, [("hot", 9000), ("a", 50), *tail])
    rows = mixing.schedule(frame, block_rows=2).collect()
    sizes = Counter(r.source for r in rows)
    assert sizes == {"hot": 9000, "a": 50, **dict(tail)}
    assert all(r.in_mix and r.release <= r.slot < r.deadline for r in rows)
    blocks = Counter((r.source, r.block) for r in rows)
    assert len({r.slot for r in rows}) == len(blocks) and max(blocks.values()) == 2
    # A block inside its window is less than a block away from its source's line.
    turn = max(mixing.PERIOD, 1 << (8 * len(sizes)).bit_length())
    names = sorted(sizes)
    share = dict(zip(names, mixing.units([sizes[n] for n in names], turn)))
    for r in rows:
        q = share[r.source]
        assert r.block * turn / q - 1 < r.slot < (r.block + 1) * turn / q
        assert r.slot * q / turn - 1 < r.block + 1 and r.block < (r.slot + 1) * q / turn
    # Nothing leaves unless weights ask for it, whatever the sizes.
    assert mixing.mix(frame).count() == len(rows)


def test_mix_is_written_in_the_order_of_slots(spark, tmp_path):
    frame = docs(spark, [("a", 600), ("b", 300), ("c", 100)], [(None, None, "t"), (5, "a", "u")])
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns and mixed.count() == 1002
    slot = {r.doc_id: r.slot for r in mixing.schedule(frame).collect() if r.doc_id != 5}
    mixed.write.parquet(str(tmp_path / "mixed"))
    files = sorted((tmp_path / "mixed").glob("part-*"))
    order = [i for f in files for i in spark.read.parquet(str(f)).toPandas()["doc_id"]]
    own = [slot[i] for i in order if i == i and i != 5]
    assert own == sorted(own) and len(own) == 999  # 5 stands at the first slot of its rows
    # A source has its share of any stretch, give or take a block of 16 at either end.
    source = {r.doc_id: r.source for r in frame.collect()}
    stretch = Counter(source[i] for i in order[200:700] if i == i)
    assert abs(stretch["a"] - 300) <= 40 and abs(stretch["b"] - 150) <= 40


def test_given_weights_reach_sources_of_any_size(spark, monkeypatch):
    frame = docs(spark, [("big", 300), ("large", 200), ("small", 40), ("least", 20)])
    rows = mixing.schedule(frame, {"small": 2, "least": 1}, block_rows=1).collect()
    mixed = Counter(r.source for r in rows if r.in_mix)
    assert set(mixed) == {"small", "least"}
    assert mixed["small"] >= 39 and mixed["least"] >= 19
    assert {r.source for r in mixing.mix(frame, {"small": 2, "least": 1}).collect()} == {"small", "least"}
    monkeypatch.setattr(mixing, "PERIOD", 2)
    rows = mixing.schedule(frame, {"small": 2, "least": 1, "big": 1}, block_rows=1).collect()
    mixed = Counter(r.source for r in rows if r.in_mix)
    assert set(mixed) == {"small", "least", "big"}


def test_query_against_a_plain_schedule(spark):
    """Earliest deadline first over the query's own weights, walked slot by slot for the whole mix."""
    sf_dir = "/root/testdata/sf0.001"
    rows = mixing.op4_mixing(spark, sf_dir).collect()
    sizes = Counter(r.source or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert Counter(r.source for r in rows) == sizes
    names = sorted(sizes)
    weights, over = mixing.capped([sizes[n] for n in names], mixing.MAX_SHARE)
    share = mixing.units(weights, mixing.PERIOD)
    turn = sum(share)
    blocks = {n: -(-sizes[n] // mixing.BLOCK_ROWS) for n in names}
    found = {(r.source, r.block): r.slot for r in rows}
    assert set(found) == {(n, b) for n in names for b in range(blocks[n])}
    nexts, plain = dict.fromkeys(names, 0), {}
    for slot in range(max(found.values()) + 1):
        ready = [
            (-(-(nexts[n] + 1) * turn // q), i, n)
            for i, (n, q) in enumerate(zip(names, share))
            if nexts[n] * turn // q <= slot
        ]
        _, _, n = min(ready)
        plain[n, nexts[n]] = slot
        nexts[n] += 1
    assert {k: plain[k] for k in found} == found
    assert not any(over) and all(r.in_mix for r in rows)
