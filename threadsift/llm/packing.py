"""Best-fit packing of tokenized documents into sequences of a fixed length.

``token_pieces`` turns texts into token ids (the end mark included) and cuts only what is longer than a
sequence. ``pack`` places pieces: every partition packs its pieces by best-fit decreasing and certifies
its number of bins with dual feasible functions. A partition whose bins exceed its bound has a gap. It keeps
its full bins and gives the pieces of its loosest bins to the exchange; every other partition gives its one
loosest bin, so that the remainders of all partitions meet as well. The given pieces are dealt to new, fewer
partitions and packed again, until one partition holds what is left.

Defined results: a NULL or empty text is the end mark alone; equal lengths are ordered by key and piece; repeated
rows are packed as often as they occur; an empty table gives no pieces.
"""

from __future__ import annotations

import array
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.hashing import flat, groups
from threadsift.llm.tables import settled
from threadsift.llm.workers import kept, trim

MAX_TOKENS = 4096
END_ID = 1
#: Pieces that one task packs; some 30 bytes each.
PIECES_PER_TASK = 100_000
#: Words whose ids a worker remembers from its latest texts, and as many from before; some 200 bytes each.
REMEMBERED_WORDS = 600_000
HOT_WORDS = 16_000
#: Text that is tokenized at a time.
_STEP_BYTES = 1 << 20
#: Words that are encoded at a time.
_WORDS_AT_ONCE = 4096

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_split_mark = re.compile(rb"([a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])([.,])(?=[ \n]|$)").sub


def _classes() -> bytes:
    """What a byte of a lower-case text is: d full stop or comma, p other ASCII mark, blank, C the lead of Latin letters
    of two bytes, h a byte that may follow it, H other bytes above ASCII, a the rest."""
    out = bytearray(b"a" * 128 + b"h" * 64 + b"H" * 64)
    for c in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]:
        out[c] = ord("p")
    out[ord(".")] = out[ord(",")] = ord("d")
    out[32] = out[10] = ord(" ")
    out[0xC3], out[0x97], out[0xB7] = ord("C"), ord("H"), ord("H")
    return bytes(out)


_CLASSES = _classes()


def _words(text: bytes) -> list[bytes]:
    """White-space separated words in lower case, without a full stop or comma behind a letter, which become words. The
    tokenizer takes marks and letters apart anyway, and like this there are fewer different words."""
    text = text.translate(_LOWER)
    kinds = text.translate(_CLASSES) + b" "
    if any(odd in kinds for odd in (b"pd ", b"dd ", b"hhd ", b"Hhd ", b"Hd ")):  # a mark behind what may be a mark
        return _split_mark(rb"\1 \2", text).split()
    return text.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n").split()


#: Control characters that are not white space, and the first bytes of the combining marks from U+0300 to U+036F.
_ODD = bytes([*range(9), *range(0x0E, 0x20), 0x7F, 0xCC, 0xCD])
_C1 = re.compile(rb"\xc2[\x80-\x9f]")


def _odd(text: bytes) -> bool:
    """Whether a text has what may differ between words and the whole: control characters, behind which marks would be
    taken off, and combining marks, which may compose with a lower-case letter only."""
    return len(text.translate(None, _ODD)) != len(text) or (b"\xc2" in text and _C1.search(text) is not None)


class _Known:
    """Ids of words, one after the other."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.begin, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def add(self, words: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.begin), len(self.begin) + len(words)), strict=True))
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(count) - count))
        self.count, self.ids = np.concatenate((self.count, count)), np.concatenate((self.ids, ids))

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places, and how many each has."""
        count = self.count[at]
        ends = np.cumsum(count)
        return self.ids[np.repeat(self.begin[at] - (ends - count), count) + np.arange(ends[-1] if len(at) else 0)], count


class WordTokenizer:
    """Ids of whole texts by a tokenizer that lower-cases and never joins across white space.

    Such a tokenizer gives a text the ids of its white-space separated words, one after the other, so each
    word is encoded once and remembered. Texts with a special token's opening, control characters or combining marks go
    through the tokenizer whole.
    """

    def __init__(self, definition: str, remembered: int | None = None):
        from tokenizers import Tokenizer

        self._most = remembered or REMEMBERED_WORDS
        self._tokenizer = Tokenizer.from_str(definition)
        kinds = json.dumps(json.loads(definition).get("normalizer"))
        self._by_word = '"Lowercase"' in kinds and "\\\\s+" in kinds
        suffix = json.loads(definition).get("model", {}).get("end_of_word_suffix")
        vocabulary = self._tokenizer.get_vocab() if suffix else {}
        self._ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)  # tokens that end a run of letters
        self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._known, self._older = _Known(), _Known()
        self._hot: dict[bytes, int] = {}  # the most frequent words, few enough to stay in the processor's cache
        self._seen, self._steps = np.zeros(0, np.int64), 0

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        whole = [not self._by_word or b"<|" in t or _odd(t) for t in texts]
        split = [[] if w else _words(t) for t, w in zip(texts, whole, strict=True)]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self._hot.get, words, repeat(-1)), np.int64, len(words))
        cold = np.flatnonzero(at < 0)
        rare = [words[i] for i in cold.tolist()]
        at[cold] = np.fromiter(map(self._known.place.get, rare, repeat(-1)), np.int64, len(rare))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            missing = {words[i] for i in unknown.tolist()}
            if len(self._known.place) + len(missing) > self._most:
                self._known, self._older = _Known(), self._known
                self._hot, self._seen, self._steps = {}, np.zeros(0, np.int64), 0
                missing, unknown = set(words), np.arange(len(words))
            self._learn(missing)
            at[unknown] = np.fromiter(map(self._known.place.__getitem__, (words[i] for i in unknown.tolist())), np.int64, len(unknown))
        self._warm(at)
        ids, count = self._known.of(at)
        ends = np.concatenate(([0], np.cumsum(count)))[np.cumsum([0, *map(len, split)])].tolist()
        return [self._whole(t) if w else ids[a:b].tobytes() for t, w, a, b in zip(texts, whole, ends[:-1], ends[1:], strict=True)]

    def _whole(self, text: bytes) -> bytes:
        return np.asarray(self._tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _warm(self, at: np.ndarray) -> None:
        self._steps += 1
        if self._steps > 16:
            return
        seen = np.bincount(at, minlength=len(self._known.begin))
        seen[: len(self._seen)] += self._seen
        self._seen = seen
        if self._steps in (1, 4, 16):
            hot = set(np.argsort(-seen, kind="stable")[:HOT_WORDS].tolist())
            self._hot = {w: i for w, i in self._known.place.items() if i in hot}

    def _learn(self, words: set[bytes]) -> None:
        again = [w for w in words if w in self._older.place]
        if again:
            self._known.add(again, *self._older.of(np.array([self._older.place[w] for w in again])))
        new = [w.decode() for w in words.difference(again)]
        letters, others = [w for w in new if w.isalpha()], [w for w in new if not w.isalpha()]
        parts = [
            encode(kind[i : i + _WORDS_AT_ONCE])
            for kind, encode in ((letters, self._encode_letters), (others, self._encode_words))
            for i in range(0, len(kind), _WORDS_AT_ONCE)
        ]
        if parts:
            self._known.add([w.encode() for w in chain(letters, others)], *map(np.concatenate, zip(*parts, strict=True)))

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self._tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.asarray(got.ids, "<u4"), np.bincount(np.asarray(got.word_ids, np.int64), minlength=len(words))

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters as one text: each is one run, so the tokens that end runs tell the words apart."""
        ids = np.asarray(self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) if len(self._ends) else np.zeros(0, np.int64)
        if len(ends) != len(words) or ends[-1] != len(ids) - 1:  # a letter that lower case or composition takes apart
            return self._encode_words(words)
        return ids, np.diff(ends, prepend=-1)


def token_pieces(docs: DataFrame, tokenizer_file: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, remembered: int = REMEMBERED_WORDS) -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian unsigned 32-bit numbers. ``remembered`` words take
    memory and save time."""
    with open(tokenizer_file) as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.string()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept((hash(definition.value), remembered), lambda: WordTokenizer(definition.value, remembered))
        end, width = array.array("I", [end_id]).tobytes(), 4 * max_tokens
        for batch in batches:
            _, offsets = flat(batch.column(1))
            for i, j in groups(offsets, _STEP_BYTES):
                keys, texts = batch.column(0).slice(i, j - i).to_pylist(), batch.column(1).slice(i, j - i).cast(pa.binary()).to_pylist()
                out: tuple[list, ...] = ([], [], [], [], [])
                for key, ids in zip(keys, tokenizer.ids([t or b"" for t in texts]), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        for column, value in zip(out, (key, piece, at // 4, len(part) // 4, part), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
        trim()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    pieces = rows.mapInArrow(cut, "doc_id string, piece int, start long, length long, ids binary")
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs. ``counts[s]``: number of pieces of length s.

    The largest bound of two families of dual feasible functions: one rounds pieces above capacity - a up
    and drops those below a, for every a up to half the capacity; the other rounds multiples of
    capacity / (k + 1).
    """
    sizes = np.arange(capacity + 1, dtype=np.int64)
    number = np.concatenate(([0], np.cumsum(counts)))
    weight = np.concatenate(([0], np.cumsum(counts * sizes)))
    a = np.arange(0, capacity // 2 + 1)
    inner = weight[capacity - a + 1] - weight[a]
    outer = number[-1] - number[capacity - a + 1]
    best = int((-(-(inner + capacity * outer) // capacity)).max())
    for k in range(1, 33):
        parts = (k + 1) * sizes
        exact = parts % capacity == 0
        value = np.where(exact, sizes * k, (parts // capacity) * capacity)  # times 1 / k of the capacity
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece (``lengths`` is in descending order), and the room left in each bin."""
    by_room: dict[int, list[int]] = defaultdict(list)
    mask, room = 0, []  # bit r of mask: a bin with room r exists
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                mask &= ~(1 << left)
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        left -= size
        room[b] = left
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.asarray(room, np.int64)


@dataclass
class Packing:
    """pieces: the given columns with sequence_id and offset; rounds: one dict per round of exchange."""

    pieces: DataFrame
    bound: int
    sequences: int
    rounds: list[dict]


def _pack_partitions(capacity: int, round_no: int, last: bool, close_gaps: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = pd.concat(list(batches) or [pd.DataFrame()], ignore_index=True)
        if rows.empty:
            return
        part = TaskContext.get().partitionId()
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        given = np.zeros(len(room), bool)
        if not last:
            give = 1 if gap == 0 or not close_gaps else min(4 * gap + 2, len(room) // 8 + 1)
            given[np.argsort(-room, kind="stable")[:give]] = True
            given &= room > 0
        rows["sequence_id"] = (np.int64(round_no) << 56) + (np.int64(part) << 24) + bins
        rows["offset"] = offsets
        rows["given"] = given[bins]
        yield rows

    return run


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, pieces_per_task: int = PIECES_PER_TASK) -> Packing:
    """Packs ``pieces`` (doc_id, piece, length and any narrow columns, which are carried along)."""
    if pieces_per_task >= 1 << 24:
        raise ValueError("pieces_per_task must be below 2**24")
    key_type = pieces.schema["doc_id"].dataType
    todo = settled(pieces.withColumn("doc_id", F.col("doc_id").cast("string")), "pieces")  # pandas has no NULL long
    counts = np.zeros(capacity + 1, np.int64)
    for row in todo.groupBy("length").count().collect():  # at most one row per length up to the capacity
        counts[row["length"]] = row["count"]
    bound, left = lower_bound(counts, capacity), int(counts.sum())
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema)
    done, rounds, close_gaps = [], [], True
    while left or not rounds:
        tasks = max(1, -(-left // pieces_per_task))
        last = tasks == 1
        packed = todo.repartition(tasks).mapInPandas(
            _pack_partitions(capacity, len(rounds), last, close_gaps), f"{carried}, sequence_id long, offset long, given boolean"
        )
        packed = settled(packed, "packed")
        done.append(packed.filter("not given").drop("given"))
        todo = packed.filter("given").select(*todo.columns)
        before, left = left, 0 if last else todo.count()
        rounds.append({"tasks": tasks, "pieces": before, "given": left})
        close_gaps = left <= before // 2  # else gaps would keep more moving than a round may pass on
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    whole = whole.withColumn("doc_id", F.col("doc_id").cast(key_type))
    sequences = sum(d.select("sequence_id").distinct().count() for d in done)
    return Packing(whole, bound, sequences, rounds)


def token_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, n_tokens, ids). ``pieces`` has ids, ``placed`` the places."""
    keyed = placed.select("doc_id", "piece", "sequence_id", "offset").distinct()
    joined = pieces.select("doc_id", "piece", "length", "ids").distinct().join(keyed, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined_ids = F.aggregate(parts, F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return joined.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined_ids.alias("ids"))
