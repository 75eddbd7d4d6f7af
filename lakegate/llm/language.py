"""Language identification of mixed texts.

The scripts of a word's letters narrow the candidate languages; letter trigrams give the word
a score for each of them; Viterbi over the words, with a penalty for every switch, labels
spans. A document's language is that of most of its letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.llm.common import fold, list_array, mix64, rows_at_most, table

#: At most so many documents of each language are learned from, taken in hash order of the id.
SAMPLE_ROWS = 5_000
#: Trigrams are counted in so many hash buckets.
BUCKETS = 1 << 15
#: Cost of a switch of language, in nats.
SWITCH = 9.0
#: A language uses a script if at least this share of its letters is of it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"

# First code point of each range of letters of one script, by Unicode's blocks.
SCRIPTS = (
    (0x0041, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "other Indic"),
    (0x0E00, "Thai"),
    (0x0E80, "other Asian"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "other"),
    (0x3040, "Kana"),
    (0x3100, "other"),
    (0x3400, "Han"),
    (0xA000, "other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "other"),
    (0xF900, "Han"),
    (0xFB00, "other"),
    (0x20000, "Han"),
    (0x30000, "other"),
)
_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

_WORD = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 100_000
_WORDS_AT_ONCE = 1_000_000


def letter_words(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def _points(words: list[str]) -> np.ndarray:
    """Code points of the words, each with a space before it, and a last space."""
    return np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)


def _trigrams(points: np.ndarray) -> np.ndarray:
    """Hash buckets of the trigrams around each inner code point."""
    x = points.astype(np.uint64)
    hashed = mix64((x[:-2] << np.uint64(42)) | (x[1:-1] << np.uint64(21)) | x[2:])
    return (hashed % np.uint64(BUCKETS)).astype(np.int64)


def scripts_of(points: np.ndarray) -> np.ndarray:
    """The script number of each letter."""
    place = np.maximum(np.searchsorted(_STARTS, points, side="right") - 1, 0)
    return _SCRIPT_OF_RANGE[place]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: trigram counts by bucket, then script counts from -1 down."""
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in rows_at_most(batches, 256):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            grams, scripts = counts.setdefault(
                lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64))
            )
            words = letter_words(text)
            if not words:
                continue
            points = _points(words)
            inner = points[1:-1] != 32
            grams += np.bincount(_trigrams(points)[inner], minlength=BUCKETS)
            scripts += np.bincount(scripts_of(points[1:-1][inner]), minlength=len(SCRIPT_NAMES))
    for lang, (grams, scripts) in counts.items():
        used, own = np.flatnonzero(grams), np.flatnonzero(scripts)
        place = np.concatenate((used, -1 - own))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(place)), pa.array(place), pa.array(np.concatenate((grams[used], scripts[own])))],
            names=["lang", "place", "n"],
        )


@dataclass
class Model:
    """Log probability of each trigram bucket (rows) in each language, and scripts in use."""

    languages: list[str]
    grams: np.ndarray
    scripts: np.ndarray


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` documents of each language outside the held-out fold.

    Every language that has a document there is learned, however rare it is. (Of rows that share
    the last id of a sample all are taken.)
    """
    known = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2))
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("_order"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    taken = known.select("lang", "_order").withColumn("_number", first).where(F.col("_number") <= sample_rows)
    # One row per language.
    edges = taken.groupBy("lang").agg(F.max("_order").alias("_edge"))
    edges = {r["lang"]: r["_edge"] for r in edges.collect()}
    if not edges:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    held = docs.sparkSession.createDataFrame(list(edges.items()), "_lang string, _edge long")
    sample = known.join(F.broadcast(held), (F.col("lang") == F.col("_lang")) & (F.col("_order") <= F.col("_edge")))
    sample = sample.select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, place long, n long")
    # At most one row per language, bucket and script.
    rows = counts.groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(edges)
    number = {lang: i for i, lang in enumerate(languages)}
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    who = np.array([number[lang] for lang in rows["lang"].to_pylist()], np.int64)
    place, n = rows["place"].to_numpy(), rows["n"].to_numpy()
    gram = place >= 0
    grams[place[gram], who[gram]] = n[gram]
    scripts[-1 - place[~gram], who[~gram]] = n[~gram]
    smoothed = np.log(grams + 0.5) - np.log(grams.sum(0) + 0.5 * BUCKETS)
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    return Model(languages, smoothed, used)


class _WordScores:
    """Scores of words seen, one row per word; row 0 is for runs without a letter."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1024, np.int64)
        self.used = 1

    def add(self, words: list[str]) -> None:
        points = _points(words)
        inner = points[1:-1] != 32
        starts = np.concatenate(([0], np.cumsum([len(w) for w in words])))[:-1]
        each = self.model.grams[_trigrams(points)[inner]]
        summed = np.add.reduceat(each, starts, axis=0)
        # Only languages that use the scripts of all of a word's letters are candidates, or, if
        # none does, those that use one of them.
        letters = self.model.scripts[scripts_of(points[1:-1][inner])]
        allowed, some = (f.reduceat(letters, starts, axis=0) for f in (np.logical_and, np.logical_or))
        allowed = np.where(allowed.any(axis=1, keepdims=True), allowed, some)
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        summed = np.where(allowed, summed, summed.min(axis=1, keepdims=True) - 20.0)
        # Only differences count; the best candidate is 0.
        summed -= summed.max(axis=1, keepdims=True)
        end = self.used + len(words)
        while end > len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
            self.letters = np.concatenate((self.letters, np.zeros_like(self.letters)))
        self.scores[self.used : end] = summed
        self.letters[self.used : end] = [len(w) for w in words]
        for i, word in enumerate(words):
            self.rows[word] = self.used + i
        self.used = end

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Row numbers of the words of each text, runs without a letter left out."""
        if self.used > _CACHED_WORDS:
            self.clear()
        rows = self.rows
        new = {w for words in texts for w in words if w not in rows}
        odd = {w for w in new if not w.isalpha() and not any(c.isalpha() for c in w)}
        for word in odd:
            rows[word] = 0
        if new - odd:
            self.add(sorted(new - odd))
        found = [np.fromiter(map(rows.__getitem__, words), np.int64, len(words)) for words in texts]
        return [x[x > 0] for x in found]


def viterbi(rows: list[np.ndarray], scores: np.ndarray, switch: float) -> list[np.ndarray]:
    """The best language of each word of each text, all texts a step at a time."""
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    lengths = np.array([len(rows[i]) for i in order], np.int64)
    flat = np.concatenate([rows[i] for i in order]) if rows else np.empty(0, np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    steps = int(lengths[0]) if len(lengths) else 0
    # Texts are sorted by length, so those with a word at step t are the first active[t].
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    came = np.empty((len(flat), scores.shape[1]), np.int8 if scores.shape[1] < 128 else np.int16)
    best = np.zeros((len(rows), scores.shape[1]), np.float32)
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        now = best[:n]
        top = now.argmax(axis=1)
        jump = now[np.arange(n), top] - switch
        stays = now >= jump[:, None]
        came[at] = np.where(stays, np.arange(scores.shape[1]), top[:, None])
        best[:n] = np.where(stays, now, jump[:, None]) + scores[flat[at]]
    path = np.empty(len(flat), came.dtype)
    label = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = label[:n]
        label[:n] = came[at, label[:n]]
    out: list[np.ndarray] = [path[:0]] * len(rows)
    for i, start, length in zip(order, starts, lengths):
        out[i] = path[start : start + length]
    return out



def _labeller(model: Model, switch: float):
    langs = pa.array(model.languages, pa.string())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordScores(model) if model.languages else None
        for batch in rows_at_most(batches, 4096):
            texts = batch.column("text").to_pylist()
            start = 0
            while start < len(texts):
                words, total, end = [], 0, start
                while end < len(texts) and total < _WORDS_AT_ONCE:
                    words.append(letter_words(texts[end]))
                    total += len(words[-1])
                    end += 1
                part = batch.slice(start, end - start)
                start = end
                yield _labelled(part, words, known, langs, switch)

    return label


def _labelled(batch, words, known, langs, switch) -> pa.RecordBatch:
    count = len(words)
    rows = known.numbers(words) if known else [np.empty(0, np.int64)] * count
    paths = viterbi(rows, known.scores, switch) if known else rows
    pred, score, spans = np.full(count, -1), np.zeros(count), []
    for i, (own, path) in enumerate(zip(rows, paths)):
        if not len(path):
            spans.append(0)
            continue
        weight = np.bincount(path, known.letters[own], len(langs))
        pred[i] = weight.argmax()
        score[i] = weight.max() / weight.sum()
        spans.append(1 + int(np.count_nonzero(path[1:] != path[:-1])))
    firsts, lasts, names = [], [], []
    for path in paths:
        if len(path):
            cut = np.flatnonzero(path[1:] != path[:-1]) + 1
            firsts.append(np.concatenate(([0], cut)))
            lasts.append(np.concatenate((cut, [len(path)])))
            names.append(path[firsts[-1]])
    join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    flat = pa.StructArray.from_arrays(
        [pa.array(join(firsts)), pa.array(join(lasts)), langs.take(pa.array(join(names)))],
        names=["first_word", "end_word", "lang"],
    )
    guess = langs.take(pa.array([None if p < 0 else int(p) for p in pred], pa.int64()))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), guess.fill_null(UNKNOWN), pa.array(score), list_array(spans, flat)],
        names=["doc_id", "lang_pred", "score", "spans"],
    )


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and spans of every row.

    ``score`` is the share of the text's letters that are labelled ``lang_pred``; ``spans`` has
    first_word, end_word (exclusive) and lang of each span, in runs of letters counted from 0.
    A null text, one without a letter, or a model without languages gives 'und', 0 and no
    spans. Ties go to the language that comes first by name. Only ``doc_id`` and ``text`` are
    read; rows that repeat are labelled each; an empty table gives no rows.
    """
    slim = docs.select("doc_id", "text")
    span = "array<struct<first_word:bigint,end_word:bigint,lang:string>>"
    schema = T.StructType(
        [
            slim.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.StructType.fromDDL(f"s {span}")["s"].dataType),
        ]
    )
    return slim.mapInArrow(_labeller(model, switch), schema)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, train(docs)).select(
        "doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op10_language": (op10_language, None)}
