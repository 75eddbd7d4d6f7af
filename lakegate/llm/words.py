"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import mix64

#: Texts are read in parts of about so many bytes.
PART_BYTES = 4 << 20
_HASHED_BYTES = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

SEPARATOR, WORD, BREAK = 0, 1, 2


def byte_kinds(separators: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: a break ends a piece of text, all that is neither it nor a separator is a word's."""
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(separators)] = SEPARATOR
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass(frozen=True)
class Words:
    """The words of some texts in order, A-Z lower-cased (ASCII only)."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # number of the text a word is in
    fresh: np.ndarray  # whether a word begins a piece: a text, or what follows a break
    texts: int

    def __len__(self) -> int:
        return len(self.starts)

    def spelled(self, i: int, j: int) -> bytes:
        """Words i to j - 1, with a space between."""
        return b" ".join(self.data[s:e] for s, e in zip(self.starts[i:j], self.ends[i:j]))

    def column(self, which: np.ndarray) -> pa.Array:
        """The words of these numbers."""
        size = self.ends[which] - self.starts[which]
        offsets = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(offsets[-1]) + np.repeat(self.starts[which] - offsets[:-1], size)
        held = np.frombuffer(self.data, np.uint8)[at]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(held)]
        return pa.Array.from_buffers(pa.large_binary(), len(size), buffers).cast(pa.binary()).cast(pa.string())

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.text, minlength=self.texts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A hash of each word: one to one for words of up to eight bytes."""
        if not len(self):
            return np.empty(0, np.uint64)
        padded = self.data + bytes(8)
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        size = self.ends - self.starts
        value = eight[self.starts] & _MASKS[np.minimum(size, 8)]
        value = mix64(value + np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15))
        value = mix64(value + size.astype(np.uint64))
        more, done = np.flatnonzero(size > 8), 8
        while len(more) and done < _HASHED_BYTES:
            rest = size[more] - done
            part = eight[self.starts[more] + done] & _MASKS[np.minimum(rest, 8)]
            value[more] = mix64(value[more] + part)
            done += 8
            more = more[rest > 8]
        for i in more:
            value[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]], seed & 0xFFFFFFFF)
        return value


def words(column: pa.Array, kinds: np.ndarray) -> Words:
    """The words of a column of texts; null as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    first, last = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    data = held.slice(first, last - first).to_pybytes().lower() if held is not None and last > first else b""
    ends_of_texts = offsets[1:] - first if len(column) else np.empty(0, np.int64)
    border = np.unique(np.concatenate(([0], ends_of_texts)))
    raw = np.frombuffer(data, np.uint8)
    starts, ends, breaks = [], [], []
    for low in range(0, len(raw), PART_BYTES):
        high = min(low + PART_BYTES, len(raw))
        # One byte more on each side; what lies outside the data is no word.
        kind = np.full(high - low + 2, SEPARATOR, np.uint8)
        near = max(low - 1, 0), min(high + 1, len(raw))
        kind[near[0] - low + 1 : near[1] - low + 1] = kinds[raw[near[0] : near[1]]]
        inside = kind == WORD
        cut = np.zeros(high - low + 1, bool)  # a text begins at this byte
        cut[border[np.searchsorted(border, low) : np.searchsorted(border, high, "right")] - low] = True
        starts.append(np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1])) + low)
        ends.append(np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + low + 1)
        breaks.append(np.flatnonzero(kind[1:-1] == BREAK) + low)
    begin, end, broken = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, ends, breaks))
    text = np.searchsorted(ends_of_texts, begin, "right")
    piece = np.searchsorted(broken, begin)
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
    return Words(data, begin, end, text, fresh, len(column))


def parts(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (``PART_BYTES``); a longer text is one of its own."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + (most or PART_BYTES), "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def chained(hashes: np.ndarray, width: int, seed: np.ndarray | int = 0) -> np.ndarray:
    """One hash for every ``width`` neighbours, in the order they stand; ``seed`` may differ by place."""
    count = max(len(hashes) - width + 1, 0)
    seed = seed[:count] if isinstance(seed, np.ndarray) else np.uint64(seed)
    value = mix64(hashes[:count] + seed + np.uint64(width))
    for i in range(1, width):
        value = mix64(value + hashes[i : i + count])
    return value


class Filter:
    """A set of hashes as a bitmap of fixed size: it never misses a member, and may take others for one."""

    BITS = 1 << 24

    def __init__(self, packed: np.ndarray):
        self._packed, self._bits = packed, None

    def __getstate__(self) -> dict:
        return {"_packed": self._packed, "_bits": None}

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self._bits is None:
            self._bits = np.unpackbits(self._packed.view(np.uint8), bitorder="little").view(bool)
        return self._bits[hashes & np.uint64(self.BITS - 1)]

    @classmethod
    def of(cls, frame: DataFrame, hashed: Column) -> "Filter":
        """The long values of a column: at most ``BITS`` / 64 numbers come to the driver."""
        bit = hashed.bitwiseAND(F.lit(cls.BITS - 1))
        parts = frame.select(
            F.shiftright(bit, 6).cast("int").alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("set"),
        )
        found = parts.groupBy("word").agg(F.bit_or("set").alias("set")).toArrow()
        packed = np.zeros(cls.BITS // 64, np.int64)
        packed[found["word"].to_numpy()] = found["set"].to_numpy()
        return cls(packed)
