"""Phrase collocations by Apriori-safe candidates, counted with double-array tries.

A phrase can be frequent only if the phrases of one word less in it are. So candidates grow by
a word a level: stretches seen in the texts whose two shorter parts pass a filter of those that
reached the least count before. The filter is a bitmap of fixed size, and it only ever lets more
through. The candidates of all levels then become double-array tries of bounded size, which are
broadcast one after the other: numpy moves the states of all places of a part of the texts one
level down at a time, accepting states are counted by bincount, and the counts of all parts are
summed. Scores are exact integers.

Words are 64-bit hashes on the way; should two words of the corpus share one, another seed is
taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import list_array, table
from lakegate.llm.words import Filter, Words, byte_kinds, chained, parts, words
from lakegate.plans.staging import stage

#: A piece ends at these; its words are parted by space and tab.
KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Candidates in one trie, about.
TRIE_PHRASES = 1 << 18
#: Distinct phrases a task holds before it hands over their counts.
HELD = 1 << 19
_ROWS = 1 << 16
#: Counts of a trie leave a task in blocks, and so many tasks' blocks are summed at a time.
BLOCK = 8192
SUMMED = 64
_UNDEFINED = "und"


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``longest`` words that occur at least ``least`` times; the ``top`` of each language."""

    longest: int = 5
    least: int = 100
    top: int = 2000


def _langs(column: pa.Array) -> tuple[np.ndarray, dict[int, str]]:
    """A hash of the language of each row, and the languages."""
    names = column.cast(pa.string()).fill_null(_UNDEFINED).dictionary_encode()
    own = [xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) for n in names.dictionary.to_pylist()]
    hashes = np.array(own, np.uint64)
    return hashes[names.indices.to_numpy()], dict(zip(own, names.dictionary.to_pylist()))


def _inside(found: Words, width: int) -> np.ndarray:
    """Whether the ``width`` words from each place on are of one piece."""
    count = max(len(found) - width + 1, 0)
    piece = np.cumsum(found.fresh)
    return piece[:count] == piece[width - 1 : width - 1 + count]


class _Tally:
    """Counts of keys of some 64-bit numbers; keys are told by all of them."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.keys.append(keys)
        self.counts.append(np.ones(len(keys), np.int64) if counts is None else counts)
        self.held += len(keys)

    def merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.lexsort(keys.T)
        keys, counts = keys[order], counts[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        at = np.flatnonzero(first)
        self.keys = [keys[at]]
        self.counts = [np.add.reduceat(counts, at) if len(at) else counts[:0]]
        self.held = len(at)


def _packed(keys: np.ndarray) -> pa.Array:
    """Rows of numbers as binary, big end first, so that a prefix of words is a prefix of bytes."""
    width = keys.shape[1] * 8
    raw = np.ascontiguousarray(keys).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(keys), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _unpacked(column: pa.Array, numbers: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, numbers)


def _named(langs: np.ndarray, names: dict[int, str]) -> pa.Array:
    """The languages of these hashes."""
    known, own = np.unique(langs, return_inverse=True)
    spelled = pa.array([names[x] for x in known.tolist()], pa.string())
    return pa.DictionaryArray.from_arrays(pa.array(own.astype(np.int32)), spelled).cast(pa.string())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of each language in a part of the texts."""
    for batch in parts(batches):
        found = words(batch.column("text"), KINDS)
        langs, names = _langs(batch.column("lang"))
        hashes, lang = found.hashes(), langs[found.text]
        order = np.lexsort((hashes, lang))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (lang[order][1:] != lang[order][:-1])
        at = np.flatnonzero(new)
        first = order[at]
        counts = pa.array(np.diff(np.append(at, len(order))))
        yield pa.RecordBatch.from_arrays([_named(lang[first], names), found.column(first), counts], names=["lang", "word", "n"])


def _word_hasher(seed: int):
    """Words with their keys."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = words(batch.column("word"), KINDS).hashes(seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _packed(own[:, None])], names=[*batch.schema.names, "key"]
            )

    return add


def _hash_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for the language and key of each phrase, all of as many words."""
    for batch in batches:
        keys = batch.column("key")
        width = len(keys[0].as_py()) // 8 if len(keys) else 1
        own, (lang, _) = _unpacked(keys, width), _langs(batch.column("lang"))
        # Every place of the keys in a row, of which only those at a key's start count.
        value = chained(own.reshape(-1), width, np.repeat(lang, width))[::width]
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], names=["hash"])


def _longer(width: int, seed: int, shorter: Filter):
    """Phrases of ``width`` words whose two parts of a word less pass the filter, and their counts."""

    def rows(tally: _Tally, names: dict[int, str]) -> Iterator[pa.RecordBatch]:
        tally.merge()
        for at in range(0, tally.held, _ROWS):
            keys, counts = tally.keys[0][at : at + _ROWS], tally.counts[0][at : at + _ROWS]
            yield pa.RecordBatch.from_arrays(
                [_named(keys[:, 0], names), _packed(keys[:, 1:]), pa.array(counts)], names=["lang", "key", "n"]
            )

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, names = _Tally(), {}
        for batch in parts(batches):
            found = words(batch.column("text"), KINDS)
            langs, new = _langs(batch.column("lang"))
            names |= new
            hashes, lang = found.hashes(seed), langs[found.text]
            count = max(len(found) - width + 1, 0)
            known = shorter.has(chained(hashes, width - 1, lang))
            at = np.flatnonzero(known[:count] & known[1 : count + 1] & _inside(found, width))
            tally.add(np.stack([lang[at], *(hashes[at + i] for i in range(width))], axis=1))
            if tally.held > 2 * HELD:
                tally.merge()
                if tally.held > HELD:
                    yield from rows(tally, names)
                    tally = _Tally()
        if tally.keys:
            yield from rows(tally, names)

    return grow


class Trie:
    """A double array over phrases of numbers: the child of state s by symbol c is base[s] + c, if check there is s.

    Numbers get small codes, 1, 2, ... in their order; 0 is any number the trie lacks. A code is
    spelled in so many symbols, 1 to 256, which keeps the arrays dense.
    """

    SYMBOLS = 256

    def __init__(self, alphabet: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.alphabet, self.base, self.check, self.accept = alphabet, base, check, accept

    @staticmethod
    def _shifts(codes: int) -> range:
        """How far a code is shifted for each of its symbols."""
        return range(8 * max((max(codes - 1, 1).bit_length() - 1) // 8, 0), -1, -8)

    @classmethod
    def of(cls, phrases: list[np.ndarray]) -> "Trie":
        """A trie whose state of phrase i of the list accepts as i."""
        alphabet, codes = np.unique(np.concatenate([np.empty(0, np.uint64), *phrases]), return_inverse=True)
        sizes = np.array([len(p) for p in phrases], np.int64)
        longest, shifts = int(sizes.max(initial=0)), cls._shifts(len(alphabet))
        symbols = np.zeros((len(phrases), longest, len(shifts)), np.int64)
        held = np.arange(longest) < sizes[:, None]
        for d, shift in enumerate(shifts):
            symbols[:, :, d][held] = (codes >> shift & 255) + 1
        symbols = symbols.reshape(len(phrases), -1)
        # Nodes: distinct beginnings, level by level; node 0 is the root.
        node = np.zeros(len(phrases), np.int64)
        parents, labels, nodes = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
        for level in symbols.T:
            alive = np.flatnonzero(level)
            pairs = node[alive] * (cls.SYMBOLS + 1) + level[alive]
            distinct, inverse = np.unique(pairs, return_inverse=True)
            parents.append(distinct // (cls.SYMBOLS + 1))
            labels.append(distinct % (cls.SYMBOLS + 1))
            node[alive] = nodes + inverse
            nodes += len(distinct)
        state, base, check = cls._placed(np.concatenate(parents), np.concatenate(labels), nodes)
        accept = np.full(len(check), -1, np.int32)
        accept[state[node]] = np.arange(len(phrases), dtype=np.int32)
        return cls(alphabet, base, check, accept)

    @classmethod
    def _placed(cls, parent: np.ndarray, label: np.ndarray, nodes: int):
        """Slots for all nodes such that no two share one: the widest first, the others many at a time."""
        width = cls.SYMBOLS + 1
        children = np.bincount(parent[1:], minlength=nodes)
        begin = np.concatenate(([1], 1 + np.cumsum(children)))  # children of a node are neighbours
        taken = np.zeros(3 * nodes + 2 * width, bool)
        taken[0] = True
        offset = np.zeros(nodes, np.int64)
        rng = np.random.default_rng(0)
        inner = np.flatnonzero(children)
        inner = inner[np.argsort(-children[inner], kind="stable")]
        wide = int(np.searchsorted(-children[inner], -16, "right"))
        for n in inner[:wide]:
            own = label[begin[n] : begin[n + 1]]
            while True:
                tries = rng.integers(0, len(taken) - width, 32)
                free = ~taken[tries[:, None] + own].any(axis=1)
                if free.any():
                    break
                taken = np.concatenate((taken, np.zeros(len(taken) // 4 + width, bool)))
            offset[n] = tries[np.argmax(free)]
            taken[offset[n] + own] = True
        rest = inner[wide:]
        while len(rest):
            trial = rng.integers(0, len(taken) - width, len(rest))
            sizes = children[rest]
            owner = np.repeat(np.arange(len(rest)), sizes)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            slot = trial[owner] + label[begin[rest][owner] + inside]
            # A slot goes to the first node that asks for it; a node needs all of its own.
            _, first = np.unique(slot, return_index=True)
            won = np.zeros(len(slot), bool)
            won[first] = True
            fine = np.bincount(owner, weights=~won | taken[slot], minlength=len(rest)) == 0
            taken[slot[fine[owner]]] = True
            offset[rest[fine]] = trial[fine]
            rest = rest[~fine]
        state = np.zeros(nodes, np.int64)
        state[1:] = offset[parent[1:]] + label[1:]
        base = np.zeros(len(taken), np.int32)
        base[state] = offset
        check = np.full(len(taken), -1, np.int32)
        check[state[1:]] = state[parent[1:]]
        return state, base, check

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.zeros(len(numbers), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, numbers), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == numbers, at + 1, 0)

    def advance(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states one code further, and for which places there is one; 0 elsewhere."""
        on = code > 0
        for shift in self._shifts(len(self.alphabet)):
            following = self.base[state] + ((code - 1 >> shift & 255) + 1)
            on = on & (self.check[following] == state)
            state = np.where(on, following, 0)
        return state, on

    def packed(self) -> dict[str, bytes]:
        return {k: getattr(self, k).tobytes() for k in ("alphabet", "base", "check", "accept")}

    @classmethod
    def unpacked(cls, held: dict[str, bytes]) -> "Trie":
        kinds = {"alphabet": np.uint64, "base": np.int32, "check": np.int32, "accept": np.int32}
        return cls(**{k: np.frombuffer(held[k], kind) for k, kind in kinds.items()})


def _trie_maker(rows: pa.Table) -> pa.Table:
    """One trie of a shard: its phrases begin with the hash of their language."""
    rows = rows.sort_by([("lang", "ascending"), ("key", "ascending")])
    langs, _ = _langs(rows["lang"].combine_chunks())
    phrases = [
        np.concatenate(([lang], np.frombuffer(key, ">u8").astype(np.uint64)))
        for lang, key in zip(langs, rows["key"].to_pylist())
    ]
    held = Trie.of(phrases).packed()
    return pa.table(
        {
            "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
            "names": pa.array([rows["lang"].to_pylist()], pa.list_(pa.string())),
            "keys": pa.array([rows["key"].to_pylist()], pa.list_(pa.binary())),
            **{k: pa.array([v], pa.binary()) for k, v in held.items()},
        }
    )


def _trie_counter(trie: Trie, shard: int, phrases: int, longest: int, seed: int):
    """How often each phrase of the trie occurs in a task's texts: shard, number, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(phrases, np.int64)
        for batch in parts(batches):
            found = words(batch.column("text"), KINDS)
            langs, _ = _langs(batch.column("lang"))
            if not len(found):
                continue
            code = trie.codes(found.hashes(seed))
            root, known = trie.advance(np.zeros(len(langs), np.int64), trie.codes(langs))
            piece = np.cumsum(found.fresh)
            place = np.flatnonzero(known[found.text] & (code > 0))
            state = root[found.text[place]]
            for level in range(longest):
                fine = place + level < len(code)
                place, state = place[fine], state[fine]
                state, on = trie.advance(state, code[place + level])
                on &= piece[place + level] == piece[place]
                place, state = place[on], state[on]
                accepted = trie.accept[state]
                total += np.bincount(accepted[accepted >= 0], minlength=phrases)
        part = TaskContext.get().partitionId()
        for block in range(0, phrases, BLOCK):
            counts = total[block : block + BLOCK]
            if counts.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([block // BLOCK], pa.int32()),
                        pa.array([part], pa.int64()),
                        list_array([len(counts)], pa.array(counts)),
                    ],
                    names=["shard", "block", "part", "counts"],
                )

    return count


def _add_up(rows: pa.Table) -> pa.Table:
    """The blocks of one place, of at most ``SUMMED`` parts, as one."""
    first = rows.slice(0, 1)
    counts = rows["counts"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1).sum(axis=0)
    return pa.table(
        {
            "shard": first["shard"],
            "block": first["block"],
            "part": pa.array([first["part"][0].as_py() // SUMMED], pa.int64()),
            "counts": list_array([len(counts)], pa.array(counts)),
        }
    )


def _vocabulary(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, int]:
    """Words of each language and their counts; the frequent ones with keys; the seed of the keys.

    With that seed no two words of the corpus share a key.
    """
    counted = docs.mapInArrow(_count_words, "lang string, word string, n long")
    counted = stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    seed = 0
    while True:
        keyed = counted.mapInArrow(_word_hasher(seed), "lang string, word string, n long, key binary")
        twice = keyed.groupBy("key").agg(F.min("word").alias("low"), F.max("word").alias("high"))
        if twice.where("low <> high").isEmpty():
            return counted, stage(keyed.where(F.col("n") >= settings.least), "frequent-words"), seed
        seed += 1


def _candidates(docs: DataFrame, frequent: DataFrame, seed: int, settings: Settings) -> DataFrame | None:
    """(lang, key) of the phrases that may be frequent: no frequent one is missing."""
    level, found = frequent.select("lang", "key"), []
    for width in range(2, settings.longest + 1):
        shorter = Filter.of(level.mapInArrow(_hash_keys, "hash long"), F.col("hash"))
        seen = docs.mapInArrow(_longer(width, seed, shorter), "lang string, key binary, n long")
        seen = seen.groupBy("lang", "key").agg(F.sum("n").alias("n"))
        level = stage(seen.where(F.col("n") >= settings.least).drop("n"), f"candidates-{width}")
        if level.isEmpty():
            break
        found.append(level)
    return reduce(DataFrame.union, found) if found else None


def _counted(docs: DataFrame, candidates: DataFrame, seed: int, settings: Settings) -> DataFrame:
    """(lang, key, n) of the candidates, counted by tries that are broadcast one at a time."""
    shards = -(-candidates.count() // TRIE_PHRASES)
    # All phrases with the same first two words meet in one trie.
    shard = F.pmod(F.xxhash64("lang", F.substring("key", 1, 16)), F.lit(shards)).cast("int")
    tries = candidates.withColumn("shard", shard).groupBy("shard").applyInArrow(
        _trie_maker,
        "shard int, names array<string>, keys array<binary>, alphabet binary, base binary, check binary, accept binary",
    )
    tries = stage(tries, "tries")
    counts, form = [], "shard int, block int, part long, counts array<long>"
    for number in range(shards):
        held = tries.where(F.col("shard") == number).withColumn("phrases", F.size("keys")).drop("names", "keys")
        for row in held.collect():
            counter = _trie_counter(Trie.unpacked(row.asDict()), number, row["phrases"], settings.longest, seed)
            counts.append(stage(docs.mapInArrow(counter, form), "trie-counts"))
    sums = reduce(DataFrame.union, counts)
    while sums.groupBy("shard", "block").count().where(F.col("count") > 1).limit(1).count():
        lane = F.expr(f"part div {SUMMED}").alias("lane")
        sums = stage(sums.groupBy("shard", "block", lane).applyInArrow(_add_up, form), "trie-sums")
    total = sums.select("shard", "block", F.posexplode("counts").alias("at", "n"))
    total = total.select("shard", (F.col("block") * BLOCK + F.col("at")).alias("number"), "n")
    pair = F.posexplode(F.arrays_zip("names", "keys")).alias("number", "phrase")
    named = tries.select("shard", pair).select("shard", "number", "phrase.names", "phrase.keys")
    return named.join(total, ["shard", "number"]).select(F.col("names").alias("lang"), F.col("keys").alias("key"), "n")


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    ``a``, ``l`` and ``r`` count the phrase, its part before the cut that gives the lowest score,
    and the rest; ``n`` counts the words of the language; the score is floor(1000 a n / (l r)).
    Of equally low cuts the one after the fewest words counts. A phrase that stands, word for
    word, inside a longer frequent one as often as by itself is left out. Ranks are by falling
    score and count, then by the bytes of the phrase. Null texts count as empty, a null language
    as ``und``; rows that repeat count each. An empty table, or one without frequent phrases,
    gives no rows. Only ``text`` and ``lang`` are read.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(_UNDEFINED)).alias("lang")
    docs = docs.select(lang, "text")
    vocabulary, single, seed = _vocabulary(docs, settings)
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = _candidates(docs, single, seed, settings)
    phrases = single.select("lang", "key", "n").where("false") if candidates is None else _counted(
        docs, candidates, seed, settings
    )
    phrases = stage(phrases.where(F.col("n") >= settings.least), "phrases")
    size = (F.octet_length("key") / 8).cast("int")

    # A longer phrase is never more frequent, so the next longer ones tell of all.
    longer = phrases.where(size >= 3).select(
        "lang",
        "n",
        F.explode(F.array(F.expr("substring(key, 1, octet_length(key) - 8)"), F.expr("substring(key, 9)"))).alias("key"),
    )
    kept = phrases.join(longer.distinct(), ["lang", "key", "n"], "left_anti")

    known = single.select("lang", "key", "n").union(phrases)
    cuts = kept.select("lang", "key", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "*", F.expr("substring(key, 1, 8 * k)").alias("head"), F.expr("substring(key, 8 * k + 1)").alias("tail")
    )
    cuts = cuts.join(known.select("lang", F.col("key").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("key").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    cuts = cuts.join(totals, "lang").withColumn("score", _score("a", "l", "r", "n"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "key").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest)

    each = F.expr("transform(sequence(1, octet_length(key) div 8), i -> substring(key, 8 * i - 7, 8))")
    spelled = scored.select("lang", "key", F.posexplode(each).alias("at", "part"))
    spelled = spelled.join(single.select("lang", F.col("key").alias("part"), "word"), ["lang", "part"])
    spelled = spelled.groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    scored = scored.join(spelled, ["lang", "key"]).select(
        "lang",
        F.array_join(F.col("words.word"), " ").alias("phrase"),
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= settings.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _score(a: str, l: str, r: str, n: str) -> Column:  # noqa: E741
    """floor(1000 a n / (l r)) in decimals of 38 digits: exact up to 10^17 occurrences."""

    def whole(c: str) -> str:
        return f"cast({c} as decimal(19, 0))"

    return F.expr(f"cast(1000 as decimal(4, 0)) * {whole(a)} * {whole(n)} div ({whole(l)} * {whole(r)})")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2),
                                        lambda i: array_to_string(words[i : i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(words) >= m
), f AS (
  SELECT lang, m, phrase, string_split(phrase, ' ') AS words, count(*) AS f FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM f WHERE f >= 100
), inner_phrases AS (
  SELECT DISTINCT lang, f, unnest([array_to_string(words[1 : m - 1], ' '), array_to_string(words[2 : m], ' ')]) AS phrase
  FROM frequent WHERE m >= 3
), kept AS (
  SELECT c.* FROM frequent c ANTI JOIN inner_phrases i
    ON i.lang = c.lang AND i.phrase = c.phrase AND i.f = c.f
  WHERE c.m >= 2
), cuts AS (
  SELECT lang, m, phrase, words, f AS a, unnest(range(1, m)) AS k FROM kept
), scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.m = c.m - c.k AND y.phrase = array_to_string(c.words[c.k + 1 : c.m], ' ')
  JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""

QUERIES = {"op12_collocations": (op12_collocations, SQL)}
