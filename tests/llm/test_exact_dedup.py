"""Exact dedup against groups formed by hand."""

from __future__ import annotations

import hashlib
import random
import re

from lakegate.llm import exact_dedup


def by_hand(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id))
    out = {}
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[norm])[1]
        out[doc_id] = (keep, len(groups[norm]), keep == doc_id, hashlib.sha256(norm.encode()).hexdigest())
    return out


def test_groups_keepers_and_sizes(spark):
    rng = random.Random(3)
    base = ["", " ", None, "a b", "ab", "a\tb ", "a b", "x" * 70_000, "x" * 70_000 + " ", "x" * 70_000 + "y", "é\x0b"]
    rows = list(enumerate(rng.choice(base) for _ in range(300)))
    rows += [(1000 + i, "same text") for i in range(400)]  # a hot group over several ranges
    frame = spark.createDataFrame([(i, t, "z", 0) for i, t in rows], "doc_id long, text string, kept string, _run int")
    found = exact_dedup.content_sort(frame.repartition(4)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == by_hand(rows)
    assert found[0]._run == 0
    kept = exact_dedup.deduplicate(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in by_hand(rows).items() if v[2]}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(7, "t")] * 5 + [(None, "t"), (None, "only"), (3, None), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = exact_dedup.content_sort(frame).collect()
    assert len(found) == 9 and sum(r.kept for r in found) == 3
    assert {(r.keep_id, r.group_size) for r in found} == {(7, 6), (None, 1), (3, 2)}
    assert exact_dedup.content_sort(frame.limit(0)).collect() == []
