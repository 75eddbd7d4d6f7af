"""Packing: exact round trip, and token ids equal to those of whole texts."""

from __future__ import annotations

import sys
import zlib

from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakegate.llm import packing

TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "It's  THE end of all, don't\nyou\x0bknow? été ́x 12345 \x1c a\x1cb",
    "<|endoftext|> a<|startoftext|>b 你好 \U0001f600!!! x_y-z İΣΣ ",
    "Don't! don'. stop's x's ÉTÉ, ſtraße... ŉa İx Ǆ Ŀ ª º Word*** a-b ÿ\u0301",
    "word " * 5000,
    "longwithoutspace" * 3000,
]


def frame(spark, texts):
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, bucket string")


def test_pieces_give_back_the_ids_of_whole_texts(spark):
    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    pieces = packing.pack(frame(spark, TEXTS).repartition(3)).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for i, text in enumerate(TEXTS):
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        ids = [x for p in own for x in np.frombuffer(p.ids, "<u4").tolist()]
        assert ids == whole.encode(text or "", add_special_tokens=False).ids + [packing.END]
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
        assert all(p.length == 1 << p.bucket <= packing.LONGEST and p.offset == 0 for p in own)
        assert len(own) == len(ids) // packing.LONGEST + bin(len(ids) % packing.LONGEST).count("1")


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(None, "a b"), (3, "a b"), (3, "a b")]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((p.doc_id or 0, p.length) for p in pieces) == sorted([(0, 2), (0, 1), (3, 2), (3, 1), (3, 2), (3, 1)])
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_digests_pieces(spark, tmp_path):
    frame(spark, TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    found = packing.op1_packing(spark, str(tmp_path)).collect()
    pieces = {(p.doc_id, p.start): zlib.crc32(p.ids) for p in packing.pack(frame(spark, TEXTS)).collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in found} == pieces


def test_buckets_hold_equal_lengths(spark, tmp_path):
    packing.write_buckets(packing.pack(frame(spark, TEXTS)), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("length <> shiftleft(1, bucket)").count() == 0
    assert back.count() == packing.pack(frame(spark, TEXTS)).count()


def test_ids_of_every_public_vocabulary_are_those_of_whole_texts():
    """Vocabularies that keep white space, case or joined words are encoded text by text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["two words", "  Ünder the\tBridge,\n\n don't x-1 ", "a  b", "", " ", "ÀÉ 漢字 \U0001f600 end.", "a" * 300]
    names = sorted(p.name for p in Path(public_tokenizers.path(packing.VOCABULARY)).parent.glob("*.json"))
    checked, by_word = 0, {}
    for name in names:
        try:
            tokenizer = Tokenizer.from_file(str(public_tokenizers.path(name)))
        except Exception:  # not a tokenizer file
            continue
        known = packing.Words(str(public_tokenizers.path(name)))
        by_word[name] = known.by_word
        for text in texts:
            expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert known.ids(text.encode()) == expected, (name, text)
        checked += 1
    assert by_word[packing.VOCABULARY] and packing.words(packing.VOCABULARY).plain
    assert checked >= 1


def test_words_alike_but_for_case_and_punctuation_are_merged_once():
    known = packing.Words(str(public_tokenizers.path(packing.VOCABULARY)))
    whole, merges, merged = known.tokenizer, known.merges, []

    class Merges:
        @staticmethod
        def tokenize(spelled):
            merged.append(spelled)
            return merges.tokenize(spelled)

    known.merges = Merges
    text = "Grünstein stone, STONE (x) stone. GRÜNSTEIN!! Stone stone"
    expected = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert known.ids(text.encode()) == known.ids(text.encode()) == expected
    assert len(merged) == len(set(merged)) == 2


def test_what_a_worker_holds_of_many_words_stays_small():
    """Workers outlive their tasks, so what each holds counts against the executor in every later step."""
    known = packing.Words(str(public_tokenizers.path(packing.VOCABULARY)))
    letters = np.frombuffer(b"abcdefghijklmnopqrst", np.uint8)
    many = [letters[np.arange(400_000) // 20**k % 20] for k in range(5)]
    spaced = np.column_stack([*many, np.full(400_000, ord(" "), np.uint8)])
    distinct = spaced.tobytes()
    known.ids_of([distinct])
    caches = (known, known.stems, known.older_stems, known.tails)
    held = sum(sys.getsizeof(c) + sum(map(sys.getsizeof, [*c.keys(), *c.values()])) for c in caches)
    assert held + known.slots.nbytes + known.kept.nbytes < 80e6
    last = distinct[-600:]
    expected = known.tokenizer.encode(last.decode(), add_special_tokens=False).ids
    assert np.frombuffer(known.ids(last), "<u4").tolist() == expected


def test_ids_stay_right_while_words_are_given_up(monkeypatch):
    small = {"WORDS_AT_ONCE": 7, "SLOT_BITS": 3, "KEPT_IDS": 20}
    for name, value in {**small, "CACHED_WORDS": 2, "CACHED_STEMS": 3, "CACHED_TAILS": 2}.items():
        monkeypatch.setattr(packing, f"_{name}", value)
    known = packing.Words(str(public_tokenizers.path(packing.VOCABULARY)))
    words = [
        "The", "the,", "Über", "über!", "x-y", "n3", "don't", "end.)", "end", "ab\x00", "ab", "\x00", "ſt", "İx", "ÉTÉ;",
        "--", "seventh", "eightlet", "ninelette", "fifteen-letters", "fifteen-letters\x00", "sixteen-letters.", "w" * 60,
    ]
    texts = ["", " "] + ["\t".join(words[(k * i) % len(words)] for i in range(1, 30)) + " " * (k % 2) for k in range(40)]
    expected = [known.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert known.ids_of([t.encode() for t in texts]) == [np.array(ids, "<u4").tobytes() for ids in expected]
    assert len(known) <= 2 and len(known.stems) <= 3 and len(known.older_stems) <= 3 and len(known.tails) <= 2
    assert known.ids_of([]) == [] and known.ids_of([b""]) == [b""]
