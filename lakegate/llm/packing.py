"""Packing by power-of-two decomposition.

A document of L tokens is cut into its binary digits: pieces of ``longest`` tokens first,
then one piece for every 1 in the binary form of the rest, long ones first. Each piece is a
sequence of its own, so no sequence crosses documents, and every sequence has a power of two
of tokens, so nothing is padded. Sequences of one length form a bucket; training draws
batches from one bucket at a time (``write_buckets`` lays them out so).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lakegate.llm.common import bytes_of, giving_back, mix64, table
from lakegate.llm.words import parts

VOCABULARY = "word_bpe_49k.json"
END = 1
LONGEST = 2048

# An executor's Python workers outlive their tasks, with all they hold.
_CACHED_WORDS = 100_000
_CACHED_STEMS = 100_000
_CACHED_BYTES = 48
_CACHED_TAILS = 10_000
_PUNCTUATION = punctuation.encode()
# Words up to so many bytes are looked up in arrays: slots of four 64-bit integers, and ids.
_KEY_BYTES = 15
_SLOT_BITS = 20
_KEPT_IDS = 1 << 22
_WORDS_AT_ONCE = 1 << 16
# Texts are packed in parts of about so many bytes: their word borders, ids and pieces are held at once.
_PART_BYTES = 1 << 20
_WHITE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# The row number of a task takes the lower bits of a sequence id, the task's number the rest.
_TASK_BITS = 33
# The same for a document with a place: a text of 2 GB has fewer pieces than this.
_PIECE_BITS = 21

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


# Letters before this one, but for İ, are one letter each in lower case and change in no
# normal form, so that a run of them is one piece of the vocabulary's own splitting.
_PLAIN_LETTERS = "ɐ"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


# Texts by which a vocabulary's treatment of white space, case and letters shows.
_PROBES = (
    "two words", " at  the edges ", "Tab\tand\nline\r\n end", "Upper CASE Words, here; (so) it's 3.5 or 1,000!",
    "ÀÉ naïve Straße groß żółw", "mixed2words x-y a_b e@f.org", "a b c d", "the The THE tHe",
)


class Words(dict):
    """Token ids, as little-endian 32-bit integers, of texts between ASCII white space.

    If the vocabulary drops white space and never joins what it separates, a text's ids are
    those of its words one after the other, and words that repeat are looked up, many at once.
    The key is the word itself, its bytes and their number in two integers; it has one slot,
    which a new word takes over. A plain word that is not there, letters and then punctuation,
    is looked up by its letters in lower case, so that "Word", "word," and "word" are merged
    once; those letters go to the merges directly, if that gives what the whole tokenizer gives.
    Any other word goes through the tokenizer; the dictionary holds these, and long words.
    Probes tell both of a vocabulary; with any other kind whole texts are encoded.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self._forget()
        self.byte_letters = _byte_letters()
        self.plain = self.by_word = False
        apart = [self._encoded(w) for text in _PROBES for w in text.split()]
        self.by_word = b"".join(apart) == b"".join(map(self._encoded, _PROBES))
        if self.by_word:
            self.plain = True
            try:
                self.plain = [self[w.encode()] for text in _PROBES for w in text.split()] == apart
            except (AttributeError, TypeError, ValueError):  # a model without merges
                self.plain = False
            self._forget()

    def _forget(self) -> None:
        self.clear()
        # Full stems become the older ones; of all but them, everything is given up at once.
        self.stems: dict[bytes, bytes] = {}
        self.older_stems: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        self.slots = np.zeros((1 << _SLOT_BITS, 4), np.uint64)  # two of the key, first id, number of ids
        self.kept = np.zeros(_KEPT_IDS, "<u4")
        self.used = 0

    def _encoded(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _merged(self, stem: bytes) -> bytes:
        """Ids of plain letters in lower case."""
        ids = self.older_stems.get(stem)
        if ids is None:
            spelled = stem.decode("ascii") if stem.isascii() else "".join(map(self.byte_letters.__getitem__, stem))
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.merges.tokenize(spelled)])
        if len(stem) <= _CACHED_BYTES:
            if len(self.stems) >= _CACHED_STEMS:
                self.stems, self.older_stems = {}, self.stems
            self.stems[stem] = ids
        return ids

    def _tail(self, tail: bytes) -> bytes:
        """Ids of punctuation."""
        if len(self.tails) >= _CACHED_TAILS:
            self.tails = {}
        ids = self.tails[tail] = self._encoded(tail.decode())
        return ids

    def _plain_ids(self, word: bytes) -> bytes | None:
        """Ids of a plain word; None if it is another."""
        letters = word.rstrip(_PUNCTUATION)
        if self.plain and letters.isalpha():  # ASCII alone
            stem = letters.lower()
        else:
            text = letters.decode("utf-8", "replace")
            if not (self.plain and text.isalpha() and max(text) < _PLAIN_LETTERS and "İ" not in text):
                return None
            stem = text.lower().encode()
        ids = self.stems.get(stem)
        if ids is None:
            ids = self._merged(stem)
        if len(letters) == len(word):
            return ids
        tail = word[len(letters) :]
        found = self.tails.get(tail)
        return ids + (self._tail(tail) if found is None else found)

    def __missing__(self, word: bytes) -> bytes:
        ids = self._plain_ids(word)
        if ids is not None and len(word) <= _KEY_BYTES:  # has a slot, and its letters are held
            return ids
        if ids is None:
            ids = self._encoded(word.decode("utf-8", "replace"))
        if len(word) <= _CACHED_BYTES:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _some(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words that begin and end there, and the number of ids of each."""
        size = end - begin
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        low = eight[begin] & _MASKS[np.minimum(size, 8)]
        high = eight[begin + 8] & _MASKS[np.clip(size - 8, 0, _KEY_BYTES - 8)]
        high |= np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
        at = (mix64(low ^ mix64(high)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        slots = self.slots[at]
        hit = (slots[:, 0] == low) & (slots[:, 1] == high)
        counts = slots[:, 3].astype(np.int64)
        missing = np.flatnonzero(~hit)
        found = [self[data[i:j]] for i, j in zip(begin[missing].tolist(), end[missing].tolist())]
        counts[missing] = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.empty(counts.sum(), "<u4")
        new = np.repeat(~hit, counts)
        ids[new] = np.frombuffer(b"".join(found), "<u4")
        held = counts[hit]
        first = slots[hit, 2].astype(np.int64) - np.cumsum(held) + held
        ids[~new] = self.kept[np.repeat(first, held) + np.arange(held.sum())]
        short = np.flatnonzero(size[missing] <= _KEY_BYTES)
        if len(short):
            self._keep([found[i] for i in short], at[missing[short]], low[missing[short]], high[missing[short]])
        return ids, counts

    def _keep(self, found: list[bytes], at: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        ids = np.frombuffer(b"".join(found), "<u4")
        if self.used + len(ids) > len(self.kept):
            self.slots[:] = 0
            self.used = 0
        if len(ids) > len(self.kept):
            return
        self.kept[self.used : self.used + len(ids)] = ids
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        own, which = np.unique(at, return_index=True)
        self.slots[own] = np.column_stack([x[which].astype(np.uint64) for x in (low, high, first, counts)])

    def ids(self, text: bytes) -> bytes:
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return [self._encoded(text.decode("utf-8", "replace")) for text in texts]
        data = b" ".join([b"", *texts, bytes(16)])  # what follows the last text is no word
        white = _WHITE[np.frombuffer(data, np.uint8, len(data) - 16)]
        edges = np.flatnonzero(white[1:] != white[:-1]) + 1
        begin, end = edges[0::2], edges[1::2]
        blocks = [slice(i, i + _WORDS_AT_ONCE) for i in range(0, len(begin), _WORDS_AT_ONCE)]
        some = [self._some(data, begin[block], end[block]) for block in blocks]
        held = b"".join([ids.tobytes() for ids, _ in some])
        before = np.cumsum(np.concatenate([[0], *(counts for _, counts in some)]))
        until = np.cumsum([len(text) + 1 for text in texts])
        cuts = [0, *(4 * before[np.searchsorted(begin, until)]).tolist()]
        return [held[i:j] for i, j in zip(cuts, cuts[1:])]


_LOADED: dict[str, Words] = {}


def words(vocabulary: str) -> Words:
    if vocabulary not in _LOADED:
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        _LOADED[vocabulary] = Words(path)
    return _LOADED[vocabulary]


def binary_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Powers of two, none above ``longest`` (a power of two), largest first, that sum to ``tokens``."""
    rest = tokens % longest
    digits = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return [longest] * (tokens // longest) + digits


def _packer(vocabulary: str, end: int, longest: int, place: str | None):
    @giving_back
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = words(vocabulary), np.uint32(end).astype("<u4").tobytes()
        sequence = TaskContext.get().partitionId() << _TASK_BITS
        for batch in parts(batches, most=_PART_BYTES):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            places = batch.column(place).to_pylist() if place else [None] * batch.num_rows
            found = known.ids_of(bytes_of(batch.column("text")))
            for doc_id, at, ids in zip(batch.column("doc_id").to_pylist(), places, found):
                ids += last
                start = 0
                for k, length in enumerate(binary_lengths(len(ids) // 4, longest)):
                    piece = ids[4 * start : 4 * (start + length)]
                    number = sequence if at is None else (at << _PIECE_BITS) + k
                    for column, value in zip(out, (doc_id, start, length, piece, len(ids) // 4, number)):
                        column.append(value)
                    start += length
                    sequence += 1
            count = len(out[0])
            lengths = np.array(out[2], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(lengths),
                    pa.array(out[3], pa.binary()),
                    pa.array(out[4], pa.int64()),
                    pa.array(out[5], pa.int64()),
                    pa.array(np.zeros(count, np.int64)),
                    pa.array(np.log2(np.maximum(lengths, 1)).astype(np.int32)),
                ],
                names=PIECES.names,
            )

    return pack_rows


def pack(
    docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, longest: int = LONGEST, place: str | None = None
) -> DataFrame:
    """The pieces of all rows of ``docs``, each a sequence of its own; no shuffle.

    doc_id, start (tokens of the document before it), length, ids (little-endian unsigned
    32-bit token ids), doc_tokens (with the end token), sequence_id, offset (always 0) and
    bucket (log2 of the length). ``vocabulary`` names a public vocabulary or is an absolute
    path on every executor; ``longest`` is a power of two. Null and empty texts are the end
    token alone. A null ``doc_id`` stays null; rows that repeat are packed each. An empty
    table gives no pieces. Only ``doc_id`` and ``text`` are read, and ``place`` if given: a long
    column that numbers the rows from 0. Sequences are then numbered in the order of places and,
    within a document, of pieces, whichever task packs them.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([place] if place else []))
    return slim.mapInArrow(_packer(vocabulary, end, longest, place), PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per sequence length, for training on equal lengths."""
    pieces.write.partitionBy("bucket").parquet(path)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )


QUERIES = {"op1_packing": (op1_packing, None)}
