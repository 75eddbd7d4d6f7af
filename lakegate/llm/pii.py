"""Personal data by candidate gradient boosting, in DataFrame functions only.

Generators with a high recall propose overlapping spans next to those of the base patterns.
Boosted trees score every proposal by its format and context. They are fitted on counts: all
proposals of the corpus are counted by their binned features and by whether a base pattern
confirms them, a table whose size is bounded by the bins. What the confirming rules look at
(a leading plus, a check digit) is no feature, so the trees learn how such data looks and
where it stands. Scores are calibrated on the counts, for each generator: its threshold is the least score
whose calibrated share of confirmed proposals is high enough.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm.common import table
from lakegate.plans.staging import stage

KINDS = ("email", "ip", "card", "phone")
#: Spans of the trees need at least this calibrated share of confirmed proposals.
PRECISION = 0.98
ROUNDS = 24
RATE = 0.3

# The base patterns. Possessive, and started at the ends of runs only, which
# finds the same matches as the plain patterns without going back over long runs.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_IP_VALID = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"

# The generators of proposals.
_ANY_EMAIL = r"(?:\G|(?<![\p{L}\p{N}._%+-]))[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*+"
_ANY_NUMBER = r"(?<![0-9+(])[+]?[(]?[0-9](?:[\x20()./-]{0,3}[0-9]){6,}+"

_OPEN, _CLOSE = "\x01", "\x02"
_CHUNK = 256


def _spans(text: Column, pattern: str, needs: str | None = None) -> Column:
    """array<struct<start,end,value>> of the pattern's matches, leftmost, in code points.

    Matches are put between two marks, the text is cut at the marks, and lengths are summed:
    in chunks, then over chunks, so that a text with very many matches stays cheap.
    """
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)
    if needs:
        parts = F.when(F.contains(text, F.lit(needs)), parts).otherwise(F.array(text))
    count = F.size(parts) - 1
    pieces = F.slice(parts, 2, F.greatest(count, F.lit(0)))
    nothing = F.array().cast("array<struct<start:int,value:string>>")

    def chunk(number: Column) -> Column:
        def add(done: Column, piece: Column) -> Column:
            value = F.substring_index(piece, _CLOSE, 1)
            own = F.array(F.struct(done["length"].alias("start"), value.alias("value")))
            length = done["length"] + F.char_length(piece) - 1
            return F.struct(length.alias("length"), F.concat(done["spans"], own).alias("spans"))

        zero = F.struct(F.lit(0).alias("length"), nothing.alias("spans"))
        return F.aggregate(F.slice(pieces, number * _CHUNK + 1, F.lit(_CHUNK)), zero, add)

    chunks = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / _CHUNK).cast("int")), chunk)
    chunks = F.when(count > 0, chunks).otherwise(
        F.array().cast("array<struct<length:int,spans:array<struct<start:int,value:string>>>>")
    )

    def place(done: Column, each: Column) -> Column:
        return F.struct(
            (done["at"] + each["length"]).alias("at"),
            F.concat(done["starts"], F.array(done["at"])).alias("starts"),
        )

    first = F.struct(
        F.char_length(parts[0]).alias("at"), F.array().cast("array<int>").alias("starts")
    )
    starts = F.aggregate(chunks, first, place)["starts"]

    def shift(each: Column, start: Column) -> Column:
        return F.transform(
            each["spans"],
            lambda s: F.struct(
                (s["start"] + start).alias("start"),
                (s["start"] + start + F.char_length(s["value"])).alias("end"),
                s["value"].alias("value"),
            ),
        )

    return F.flatten(F.zip_with(chunks, starts, shift))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _between(count: Column, least: int, most: int) -> Column:
    return (count >= least) & (count <= most)


def _base(text: Column) -> dict[str, Column]:
    """The valid matches of each kind."""

    def card(span: Column) -> Column:
        digits = _digits(span["value"])
        fits = _between(F.char_length(digits), 14, 19)
        return F.when(fits, F.call_function("luhn_check", digits)).otherwise(False)

    return {
        "email": _spans(text, _EMAIL, "@"),
        "ip": F.filter(_spans(text, _IP), lambda s: s["value"].rlike(_IP_VALID)),
        "card": F.filter(_spans(text, _CARD), card),
        "phone": F.filter(
            _spans(text, _PHONE, "+"), lambda s: _between(F.char_length(_digits(s["value"])), 10, 15)
        ),
    }


def _context(character: Column) -> Column:
    """0 edge of the text, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(character == "", 0)
        .when(character.rlike(r"^\s$"), 1)
        .when(character.rlike(r"^\p{L}$"), 2)
        .when(character.rlike("^[0-9]$"), 3)
        .otherwise(4)
    )


# Feature: number of its values. At most their product of counts ever reaches the driver.
BINS = {"generator": 3, "digits": 8, "marks": 5, "left": 5, "right": 5, "shape": 4}


def _proposals(text: Column, spans: Column, generator: int) -> Column:
    """Proposals of one generator with binned features."""

    def one(span: Column) -> Column:
        value, start, end = span["value"], span["start"], span["end"]
        digits = F.char_length(_digits(value))
        marks = F.char_length(F.regexp_replace(value, r"[\p{L}\p{N}+]", ""))
        left = F.when(start > 0, F.substring(text, start, 1)).otherwise("")
        right = F.substring(text, end + 1, 1)
        sizes = (0, 6, 9, 12, 13, 16, 19)
        shape = (
            F.when(value.rlike(r"\..*\."), 3)
            .when(value.rlike(r"[.@]"), 2)
            .when(value.rlike(r"[(\x20-]"), 1)
            .otherwise(0)
        )
        kind = (
            F.lit(KINDS[generator])
            if generator < 2
            else F.when(digits >= 14, "card").otherwise("phone")
        )
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            kind.alias("kind"),
            F.lit(generator).alias("generator"),
            sum((F.when(digits > n, 1).otherwise(0) for n in sizes), F.lit(0)).alias("digits"),
            F.least(marks, F.lit(4)).alias("marks"),
            _context(left).alias("left"),
            _context(right).alias("right"),
            shape.alias("shape"),
        )

    return F.transform(spans, one)


def proposals(docs: DataFrame) -> DataFrame:
    """doc_id, base (struct of the valid base spans by kind) and proposed, for every row."""
    # The two marks must not be in the text; what replaces them is in no pattern either.
    clean = F.translate(F.coalesce(F.col("text"), F.lit("")), _OPEN + _CLOSE, "\x03\x03")
    rows = docs.select("doc_id", clean.alias("text"))
    text = F.col("text")
    found = rows.select(
        "doc_id",
        "text",
        F.struct(
            *(
                F.transform(spans, lambda s: F.struct(s["start"], s["end"])).alias(kind)
                for kind, spans in _base(text).items()
            )
        ).alias("base"),
    )
    proposed = F.concat(
        _proposals(text, _spans(text, _ANY_EMAIL, "@"), 0),
        _proposals(text, _spans(text, _IP), 1),
        _proposals(text, _spans(text, _ANY_NUMBER), 2),
    )
    return found.select("doc_id", "base", proposed.alias("proposed"))


@dataclass(frozen=True)
class Trees:
    """SQL of the summed trees over the features of ``x``, and each generator's threshold on it."""

    sql: str
    thresholds: tuple[float, ...]


def _leaf(slopes: list[tuple[float, float]]) -> float:
    g, h = sum(s[0] for s in slopes), sum(s[1] for s in slopes)
    return g / (h + 1.0)


def _cut(rows: list[tuple], slopes: list[tuple[float, float]]) -> tuple[float, int, int] | None:
    """Gain, feature and value of the best cut ``feature <= value``."""
    total = sum(s[0] for s in slopes) ** 2 / (sum(s[1] for s in slopes) + 1.0)
    best = None
    for feature, size in enumerate(BINS.values()):
        for value in range(size - 1):
            g = h = g2 = h2 = 0.0
            for row, (a, b) in zip(rows, slopes):
                if row[feature] <= value:
                    g, h = g + a, h + b
                else:
                    g2, h2 = g2 + a, h2 + b
            gain = g * g / (h + 1.0) + g2 * g2 / (h2 + 1.0) - total
            if h and h2 and gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, feature, value)
    return best


def _tree(rows: list[tuple], slopes: list[tuple[float, float]], depth: int):
    """A tree as nested (feature, value, left, right), leaves as numbers."""
    cut = _cut(rows, slopes) if depth else None
    if cut is None:
        return RATE * _leaf(slopes)
    _, feature, value = cut
    low = [i for i, r in enumerate(rows) if r[feature] <= value]
    high = [i for i, r in enumerate(rows) if r[feature] > value]
    return (
        feature,
        value,
        *(_tree([rows[i] for i in part], [slopes[i] for i in part], depth - 1) for part in (low, high)),
    )


def _value(tree, row: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    name = list(BINS)[tree[0]]
    return f"CASE WHEN x.{name} <= {tree[1]} THEN {_sql(tree[2])} ELSE {_sql(tree[3])} END"


def boost(cells: list[tuple[tuple, int, int]], precision: float = PRECISION) -> Trees:
    """Trees of depth 3 on ``cells`` (features, proposals, confirmed ones), by Newton boosting."""
    cells = sorted(cells)
    rows = [c[0] for c in cells]
    scores, trees = [0.0] * len(cells), []
    for _ in range(ROUNDS if cells else 0):
        slopes = []
        for score, (_, n, yes) in zip(scores, cells):
            p = 1 / (1 + math.exp(-score))
            slopes.append((yes - n * p, n * p * (1 - p)))
        tree = _tree(rows, slopes, 3)
        trees.append(tree)
        scores = [s + _value(tree, r) for s, r in zip(scores, rows)]
    thresholds = []
    for generator in range(BINS["generator"]):
        own = [(s, n, yes) for s, (row, n, yes) in zip(scores, cells) if row[0] == generator]
        thresholds.append(_threshold(own, precision))
    return Trees(" + ".join(map(_sql, trees)) or "0D", tuple(thresholds))


def _threshold(scored: list[tuple[float, int, int]], precision: float) -> float:
    """The least score with a calibrated share of at least ``precision``, by isotonic regression."""
    pools: list[list[float]] = []  # least score, proposals, confirmed
    for score, n, yes in sorted(scored):
        if pools and score - pools[-1][0] < 1e-12:
            pools[-1][1:] = [pools[-1][1] + n, pools[-1][2] + yes]
        else:
            pools.append([score, n, yes])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, n, yes = pools.pop()
            pools[-1][1:] = [pools[-1][1] + n, pools[-1][2] + yes]
    return next((score for score, n, yes in pools if yes >= precision * n), math.inf)


def train(found: DataFrame) -> Trees:
    """Count all proposals of :func:`proposals` by their features, and boost on the counts."""
    base = F.concat(*(F.col("base")[kind] for kind in KINDS))
    marked = found.where(F.size("proposed") > 0).select(
        F.explode(
            F.transform(
                "proposed",
                lambda p: F.struct(
                    *(p[name].alias(name) for name in BINS),
                    F.array_contains(base, F.struct(p["start"], p["end"])).cast("int").alias("_yes"),
                ),
            )
        ).alias("x")
    )
    cells = marked.groupBy(*(F.col("x")[name].alias(name) for name in BINS)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("x._yes").alias("yes")
    )
    return boost([(tuple(r[name] for name in BINS), r["n"], r["yes"]) for r in cells.collect()])


def redactions(found: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, base and added: proposals at or above the threshold that touch no base span.

    Of added spans that overlap, the first generator's stays.
    """
    base = F.concat(*(F.col("base")[kind] for kind in KINDS))
    limits = [
        f"WHEN {i} THEN {t - 1e-9!r}D" for i, t in enumerate(trees.thresholds) if not math.isinf(t)
    ]
    if not limits:
        none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
        return found.select("doc_id", "base", none.alias("added"))
    high = found.withColumn(
        "_high",
        F.expr(f"filter(proposed, x -> {trees.sql} >= CASE x.generator {' '.join(limits)} END)"),
    )

    def free(p: Column) -> Column:
        apart = ~F.exists(base, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))
        earlier = F.exists(
            F.col("_high"),
            lambda o: (o["generator"] < p["generator"]) & (o["start"] < p["end"]) & (p["start"] < o["end"]),
        )
        return apart & ~earlier

    added = F.transform(
        F.filter("_high", free),
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind")),
    )
    return high.select("doc_id", "base", added.alias("added"))


def find(docs: DataFrame) -> DataFrame:
    """The personal data of every row of ``docs``: doc_id, base, added.

    ``base`` has the arrays email, ip, card and phone of structs start, end (code points, end
    exclusive); ``added`` has structs start, end, kind. Null text counts as empty. Rows that
    repeat are searched each; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    found = stage(proposals(docs), "proposals")
    return redactions(found, train(found))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    order = F.array_sort(spans)
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            order,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts and spans of personal data."""
    found = find(table(spark, sf_dir, "documents"))

    def numbered(kind: int) -> Column:
        return F.transform(
            F.col("base")[KINDS[kind]],
            lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
        )

    names = F.array(*(F.lit(k) for k in KINDS))
    base = F.concat(*(numbered(i) for i in range(len(KINDS))))
    added = F.transform(
        "added",
        lambda s: F.struct(
            s["start"].alias("start"),
            (F.array_position(names, s["kind"]).cast("int") - 1).alias("kind"),
            s["end"].alias("end"),
        ),
    )
    return found.select(
        "doc_id",
        *(F.size(F.col("base")[kind]).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat(base, added)).alias("spans"),
    )


QUERIES = {"op3_pii": (op3_pii, None)}
