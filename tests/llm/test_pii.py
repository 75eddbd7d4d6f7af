"""Personal data: base spans against the plain patterns run by hand, trees against their laws."""

from __future__ import annotations

import hashlib
import math
import random
import re

from lakegate.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def by_hand(text):
    spans = [
        (m.start(), i, m.end())
        for i, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return [f"{list(BASE)[i]}:{a}:{b}" for a, i, b in sorted(spans)]


def texts():
    rng = random.Random(5)
    pieces = [
        "a@b.c", "x.y+z@mail-1.example.com", "a@b.c%x@d.e", "é@ü.fr", "q@w", "@", "1.2.3.4", "1.2.3.4.5.6.7.8",
        "300.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "12345678901234567890",
        "+1 (212) 555-0100", "+1(2", "+12345678901", "+1-2-3-4-5-6-7-8-9-0 ", " ", "\n", "ß𝒳", "-", ".", "\x01", "\x02", "7", "00",
    ]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    many = " ".join(f"u{i}@h{i % 7}.example.org" for i in range(3000))
    return [None, "", *made, many, "a" * 200_000 + "@x.y", "1" * 100_000, "a@b" + ".c" * 30_000]


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_query_equals_the_plain_patterns(spark, tmp_path):
    rows = texts()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in pii.op3_pii(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for i, text in enumerate(rows):
        expected = by_hand(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text[:200]
        counts = [sum(e.startswith(k) for e in expected) for k in BASE]
        assert [found[i][f"n_{k}"] for k in BASE] == counts
        assert set(expected) <= set(filter(None, found[i].spans.split(",")))


def test_added_spans_touch_no_base_span_and_look_alike(spark):
    """Addresses with letters beyond ASCII look like those the base pattern confirms."""
    rows = [f"write to user{i}@mail{i}.example.com today" for i in range(400)]
    rows += ["write to üser7@mailü7.example.com today", "the number 12345678 is none"]
    found = pii.find(frame(spark, rows)).orderBy("doc_id").collect()
    assert all(len(r.base.email) == 1 and not r.added for r in found[:400])
    assert [(a.kind, a.start, a.end) for a in found[400].added] == [("email", 9, 33)]
    assert not found[401].added


def test_trees_need_precision():
    good, bad = (2, 0, 2, 1, 1, 2), (2, 5, 0, 1, 1, 0)
    trees = pii.boost([(good, 100, 100), (bad, 100, 50), ((0, 1, 1, 1, 1, 1), 9, 9)])
    assert trees.thresholds[2] < math.inf and trees.thresholds[0] < math.inf == trees.thresholds[1]
    assert "CASE WHEN" in trees.sql
    assert pii.boost([(bad, 100, 50)]).thresholds == (math.inf,) * 3
    assert pii.boost([]).thresholds == (math.inf,) * 3


def test_empty_table(spark):
    assert pii.find(frame(spark, []).limit(0)).collect() == []
