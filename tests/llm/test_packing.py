import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from threadsift.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")
WORDS = packing.WordTokenizer(open(FILE).read())
PLAIN = Tokenizer.from_file(FILE)


def plain_ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBcÉéßΣ'.,!?-…×·1 \n\t  ́<|>/", max_size=40) | st.text(max_size=30), max_size=4))
def test_ids_by_word_equal_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = WORDS.ids([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain_ids(t) for t in texts]


def test_letters_that_lower_case_takes_apart():
    texts = ["İstanbul abc", "ǅ ﬁ ß ẞ", "각 한글 abc", "ａｂｃ ᾳ ŉ", "İ"]
    for some in (texts, ["abc def", *texts, "ghi"]):
        got = packing.WordTokenizer(open(FILE).read()).ids([t.encode() for t in some])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain_ids(t) for t in some]


def test_ids_of_all_documents(spark):
    from threadsift.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        ids = [*plain_ids(r.text or ""), 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[r.doc_id, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op2_packing"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want


def test_special_tokens_and_forgetting(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    words = packing.WordTokenizer(open(FILE).read())
    for text in ("a b c", "d e a, f.", "<|endoftext|> a <|ENDOFTEXT|>", "a b c d e f g h", "b. c, it's"):
        assert np.frombuffer(words.ids([text.encode()])[0], "<u4").tolist() == plain_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 24), min_size=1, max_size=9))
def test_bound_and_best_fit(lengths):
    capacity = 24
    lengths = np.sort(np.array(lengths))[::-1]
    bins, offsets, room = packing.best_fit_decreasing(lengths, capacity)
    assert (room >= 0).all() and (np.bincount(bins, lengths) + room == capacity).all()
    assert packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity) <= fewest(tuple(lengths), capacity) <= len(room)


def fewest(lengths, capacity):
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents(spark, docs):
    rows = [(1, "Hello, World."), (2, None), (3, ""), (4, "word " * 9000), (4, "word " * 9000), (None, "x y"), (5, "tail " * 4095)]
    pieces = packing.token_pieces(docs(*rows), FILE)
    got = pieces.collect()
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in got if r.doc_id != 4) == [(0, 0, 0, 3), (1, 0, 0, 5), (2, 0, 0, 1), (3, 0, 0, 1), (5, 0, 0, 4096)]
    assert sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 4) == [x for x in ((0, 0, 4096), (1, 4096, 4096), (2, 8192, 809)) for _ in "ab"]
    first = next(r for r in got if r.doc_id == 1)
    assert zlib.crc32(bytes(first.ids)) == zlib.crc32(np.array([*plain_ids("Hello, World."), 1], "<u4").tobytes())
    packed = packing.pack(pieces.select("doc_id", "piece", "start", "length"))
    assert check_places(packed.pieces.collect(), 4096) == packed.sequences >= packed.bound
    whole = packing.token_sequences(pieces, packed.pieces)
    assert whole.count() == packed.sequences and {len(r.ids) // 4 == r.n_tokens for r in whole.collect()} == {True}


@pytest.mark.parametrize("kind", ["small", "large"])
def test_rounds_of_exchange(spark, kind):
    rng = random.Random(4)
    low, high = (1, 60) if kind == "small" else (30, 100)
    lengths = [rng.randint(low, high) for _ in range(4000)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long").repartition(6)
    packed = packing.pack(pieces, capacity=100, pieces_per_task=300)
    rows = packed.pieces.collect()
    assert len(rows) == 4000 and sorted(r.length for r in rows) == sorted(lengths)
    alone = len(packing.best_fit_decreasing(np.sort(np.array(lengths))[::-1], 100)[2])
    assert packed.bound <= check_places(rows, 100) == packed.sequences <= alone * 1.02 + 1
    assert len(packed.rounds) > 1 and packed.rounds[-1]["tasks"] == 1


def test_no_documents(spark, docs):
    packed = packing.pack(packing.token_pieces(docs(), FILE).drop("ids"))
    assert packed.pieces.count() == 0 and packed.sequences == packed.bound == 0


def test_control_characters_and_combining_marks():
    """What the shortcut by words would take apart or compose goes through the tokenizer whole."""
    words = packing.WordTokenizer(open(FILE).read())
    for text in ("x\u0001. a", "x\u007f, a", "x\u0085. a", "x\u0080. a", "H̱ b", "á. İ̇, b"):
        assert np.frombuffer(words.ids([text.encode()])[0], "<u4").tolist() == plain_ids(text)
