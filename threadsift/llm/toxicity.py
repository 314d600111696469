"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Words of a text (runs without white space) are classified once per worker: whether they are in the learned lexicon, in
it after undoing obfuscation, begin like toxic words, are in a wider lexicon of weaker evidence, address the reader,
are in capitals or obfuscated. The features of a text are densities of these classes, how near to a second person the
lexicon words stand, rates of capitals, marks and digits, and the length.

Training uses at most ``MAX_TRAINING_ROWS`` labelled rows, those with the least hash of doc_id, and their whole texts.
Two halves of four fifths give each the lexicon for the other's features, on which the trees are trained, so no row is
described by a lexicon that has seen its label; the lexicon in use is that of both. The last fifth calibrates.
Every text is scored whole.

Defined results: a NULL or empty text has all features zero and a score like any other; several labels for a document
count as toxic if one does, NULL labels are ignored; ties in sampling go by doc_id; without labelled rows of both
classes every score is the share of toxic rows (0 without rows).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.hashing import flat
from threadsift.llm.tables import settled
from threadsift.llm.workers import release

MAX_TRAINING_ROWS = 15_000
REJECT_SCORE = 0.7
#: Entries of a lexicon at most, for each of words and beginnings and either strength.
MAX_LEXICON = 4000
#: Words and beginnings of toxic training documents that are considered at most, the most frequent ones.
MOST_UNITS = 200_000
#: How many times as frequent in toxic documents a word of the lexicon and of the wider one are.
STRONG, WEAK = 12.0, 4.0
#: Evidence for either: toxic documents with the word times the logarithm of that ratio. Among a million words chance
#: alone reaches some 14.
EVIDENCE = 18.0
#: Words a task remembers.
REMEMBERED_WORDS = 300_000
_BEGINNINGS = (5, 7)
_NEAR = 3

#: Words that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos "
    "usted ustedes tú ti tus vosotros vuestro su sus".split()
)
#: Common insults, which are in every lexicon.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers pathetic worthless scum trash clown clowns disgusting dumb fool imbecile "
    "filth vermin creep jerk freak idiota imbécil estúpido estúpida basura asqueroso idioten dummkopf blödmann abschaum "
    "versager widerlich crétin débile abruti ordure minable dégoûtant".split()
)
#: Characters that stand for letters.
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_not_letters = re.compile(r"[\W_]+")
_inner_mark = re.compile(r"[^\W\d_][*@$!|0-9._-]+[^\W\d_]")

LEXICON, BEGINNING, SECOND, CAPITALS, OBFUSCATED, HIDDEN, DIGITS, WIDER = 1, 2, 4, 8, 16, 32, 64, 128
FEATURES = (
    "lexicon_rate", "lexicon_count", "beginning_rate", "beginning_count", "hidden_rate", "hidden_count", "near_second_rate",
    "second_rate", "capital_words", "capital_letters", "exclamations", "questions", "marks", "obfuscated_words",
    "digit_words", "wider_rate", "wider_count", "log_words", "word_length",
)


def plain(word: str) -> str:
    """Lower case without marks at either end."""
    return word.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”’¿¡…")


@dataclass
class Words:
    """Classes of words, by a lexicon."""

    lexicon: frozenset[str]
    beginnings: frozenset[str]
    wider: frozenset[str]  # words and beginnings
    known: dict[bytes, int] = field(default_factory=dict)

    def classify(self, raw: bytes) -> int:
        text = raw.decode("utf-8", "replace")
        word, out = plain(text), 0
        if word in self.lexicon:
            out |= LEXICON
        begins = [word[:n] for n in _BEGINNINGS if len(word) >= n]
        if not self.beginnings.isdisjoint(begins):
            out |= BEGINNING
        if word in self.wider or not self.wider.isdisjoint(begins):
            out |= WIDER
        if word in SECOND_PERSON:
            out |= SECOND
        if len(word) > 1 and text.isupper():
            out |= CAPITALS
        if _inner_mark.search(text):
            out |= OBFUSCATED
        bare = _not_letters.sub("", word.translate(_LEET))
        if bare != word and bare in self.lexicon:
            out |= HIDDEN
        if any(c.isdigit() for c in text):
            out |= DIGITS
        return out

    def classes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.classify(w)
        return np.fromiter(map(known.__getitem__, words), np.uint8, len(words))


_UPPER, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3:0xC5] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


def features(column: pa.Array, words: Words) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    data, offsets = flat(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i in range(len(out)):
        part = data[offsets[i] : offsets[i + 1]]
        split = part.tobytes().split()
        n = len(split)
        if not n:
            continue
        kinds = words.classes(split)
        totals = [int(np.count_nonzero(kinds & c)) for c in (LEXICON, BEGINNING, HIDDEN, SECOND, CAPITALS, OBFUSCATED, DIGITS, WIDER)]
        lexicon, beginning, hidden, second, capitals, obfuscated, digits, wider = totals
        near = 0
        if lexicon + hidden and second:
            at = np.flatnonzero(kinds & (LEXICON | HIDDEN))
            people = np.flatnonzero(kinds & SECOND)
            after = np.searchsorted(people, at)
            left = at - people[np.maximum(after - 1, 0)]
            right = people[np.minimum(after, len(people) - 1)] - at
            near = int(((np.abs(left) <= _NEAR) | (np.abs(right) <= _NEAR)).sum())
        counts = np.bincount(part, minlength=256)
        letters, size = max(1, int(counts[_LETTER].sum())), len(part)
        out[i] = (
            lexicon / n, lexicon, beginning / n, beginning, hidden / n, hidden, near / n, second / n, capitals / n,
            counts[_UPPER].sum() / letters, counts[33] / size, counts[63] / size, counts[_MARK].sum() / size,
            obfuscated / n, digits / n, wider / n, wider, np.log1p(n), size / n,
        )
    return out


@dataclass
class Trees:
    """Boosted regression trees of a fixed depth on binned features, for the logistic loss."""

    cuts: list[np.ndarray]
    base: float
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature, bin, leaf values
    depth: int

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 2.0) -> Trees:
        cuts = [np.unique(np.quantile(c[np.isfinite(c)], np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T, strict=True)], 1)
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        model = cls(cuts, float(np.log(share / (1 - share))), [], depth)
        raw = np.full(len(y), model.base)
        width = bins + 1
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
            where = np.zeros(len(y), np.int64)
            chosen, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, width, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for f in range(x.shape[1]):
                    cell = where * width + binned[:, f]
                    g = np.bincount(cell, gradient, count * width).reshape(count, width).cumsum(1)
                    h = np.bincount(cell, hessian, count * width).reshape(count, width).cumsum(1)
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2) - total_g**2 / (total_h + l2)
                    gain[(h < 1) | (total_h - h < 1)] = 0
                    top = gain.argmax(1)
                    better = gain[np.arange(count), top] > best
                    best = np.where(better, gain[np.arange(count), top], best)
                    chosen[first : first + count][better] = f
                    cut[first : first + count][better] = top[better]
                node = first + where
                where = 2 * where + (binned[np.arange(len(y)), chosen[node]] > cut[node])
            g, h = np.bincount(where, gradient, 2**depth), np.bincount(where, hessian, 2**depth)
            leaves = rate * g / (h + l2)
            raw += leaves[where]
            model.nodes.append((chosen, cut, leaves))
        return model

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T, strict=True)], 1)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for chosen, cut, leaves in self.nodes:
            where = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2**level - 1 + where
                where = 2 * where + (binned[rows, chosen[node]] > cut[node])
            out += leaves[where]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step function closest to y, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    at, blocks = raw[order], []  # sum, count, first, last
    for i, value in enumerate(y[order].astype(float)):
        if blocks and at[blocks[-1][3]] == at[i]:
            blocks[-1] = (blocks[-1][0] + value, blocks[-1][1] + 1, blocks[-1][2], i)
        else:
            blocks.append((value, 1, i, i))
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b = blocks.pop()
            a = blocks.pop()
            blocks.append((a[0] + b[0], a[1] + b[1], a[2], b[3]))
    points = [(at[i], s / n) for s, n, first, last in blocks for i in dict.fromkeys((first, last))]
    return np.array([p for p, _ in points]), np.array([v for _, v in points])


@dataclass
class Model:
    words: Words
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray]
    share: float

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.share)
        raw = self.trees.raw(features(column, self.words))
        calibrated = np.interp(raw, *self.points)
        # among rows of one calibrated step the trees still order
        return np.clip(0.98 * calibrated + 0.02 / (1 + np.exp(-raw)), 0, 1)


def learnable(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1


def _units(wanted: frozenset[str] | None):
    """The words and beginnings of each text, once each, with a hash of the word before: copies of a passage have the
    same word before, so they count as one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                units, before, toxic, half = [], [], [], []
                for text, y, h in zip(*(batch.column(c).slice(i, 200).to_pylist() for c in range(3)), strict=True):
                    found, last = {}, ""
                    for w in map(plain, (text or "").split()):
                        if w and f"w{w}" not in found:
                            found[f"w{w}"] = last
                            for n in _BEGINNINGS:
                                if len(w) >= n:
                                    found.setdefault(f"b{w[:n]}", last)
                        last = w
                    own = list(found) if wanted is None else [u for u in found if u in wanted]
                    units += own
                    before += [zlib.crc32(found[u].encode()) for u in own]
                    toxic += [y] * len(own)
                    half += [h] * len(own)
                arrays = [pa.array(units, pa.string()), pa.array(before, pa.int64()), pa.array(toxic, pa.int32()), pa.array(half, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["unit", "before", "toxic", "half"])

    return run


_UNITS = "unit string, before long, toxic int, half int"


def _lexicons(rows: DataFrame) -> tuple[Words, Words, Words]:
    """Of the rows of half 0, of half 1, and of both: words and beginnings that occur in far more of the toxic than of
    the clean documents. Units are first looked for in toxic documents, then counted in the clean ones."""
    sizes = {0: [0, 0], 1: [0, 0]}
    for r in rows.groupBy("half").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        sizes[r["half"]] = [r["t"], r["n"]]

    def places_of(found: DataFrame, name: str) -> DataFrame:
        places = found.groupBy("unit", "before").agg(F.min("half").alias("a"), F.max("half").alias("b"))
        zero, one = F.sum((F.col("a") == 0).cast("int")), F.sum((F.col("b") == 1).cast("int"))
        return places.groupBy("unit").agg(zero.alias(f"{name}0"), one.alias(f"{name}1"))

    toxic_units = places_of(rows.filter("toxic = 1").mapInArrow(_units(None), _UNITS), "t")
    toxic_units = settled(toxic_units.filter(F.col("t0") + F.col("t1") >= 3).orderBy(F.desc(F.col("t0") + F.col("t1")), "unit").limit(MOST_UNITS), "units")
    wanted = frozenset(r["unit"] for r in toxic_units.select("unit").collect())  # at most MOST_UNITS
    clean_units = places_of(rows.filter("toxic = 0").mapInArrow(_units(wanted), _UNITS), "c")
    table = toxic_units.join(clean_units.withColumnRenamed("unit", "_unit"), F.col("unit") == F.col("_unit"), "left").fillna(0, ["c0", "c1"])
    table = table.select("unit", "t0", (F.col("t0") + F.col("c0")).alias("n0"), "t1", (F.col("t1") + F.col("c1")).alias("n1"))
    counted = settled(table, "units")
    out = []
    for t, n, toxic, every in (
        (F.col("t0"), F.col("n0"), *sizes[0]), (F.col("t1"), F.col("n1"), *sizes[1]),
        (F.col("t0") + F.col("t1"), F.col("n0") + F.col("n1"), sizes[0][0] + sizes[1][0], sizes[0][1] + sizes[1][1]),
    ):
        odds = ((t + 0.5) / (toxic + 1)) / ((n - t + 0.5) / (every - toxic + 1))
        found = counted.filter((odds >= WEAK) & (t * F.log(odds) >= EVIDENCE)).select("unit", (t * F.log(odds)).alias("worth"), (odds >= STRONG).alias("strong"))
        kept = {}
        for kind in ("w", "b"):
            for strong in (True, False):
                own = found.filter((F.substring("unit", 1, 1) == kind) & (F.col("strong") == strong))
                kept[kind, strong] = [r["unit"][1:] for r in own.orderBy(F.desc("worth"), "unit").limit(MAX_LEXICON).collect()]
        out.append(Words(frozenset(kept["w", True]) | INSULTS, frozenset(kept["b", True]), frozenset(kept["w", False] + kept["b", False])))
    return tuple(out)


def _featured(words: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch.column(0), words)
            yield pa.RecordBatch.from_arrays([pa.array(rows.tolist(), pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learns from the labels of learnable documents."""
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 40))
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.withColumn("place", place).orderBy("place", "doc_id").limit(max_rows)
    # at most max_rows narrow rows: bounded, so they can go to every task
    fold = F.pmod(F.xxhash64("place"), F.lit(5))
    half = F.when(fold < 4, F.pmod(fold, F.lit(2))).otherwise(2).cast("int")
    rows = settled(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic", half.alias("half")), "labelled")
    lexicons = _lexicons(rows.filter("half < 2"))
    x, y = [], []
    for part, words in enumerate((lexicons[1], lexicons[0], lexicons[2])):
        got = rows.filter(F.col("half") == part).select("text", "toxic").repartition(6).mapInArrow(_featured(words), "x array<double>, toxic int")
        got = sorted(((r["toxic"], r["x"]) for r in got.collect()))
        x.append(np.array([r[1] for r in got]).reshape(len(got), len(FEATURES)))
        y.append(np.array([r[0] for r in got], np.int64))
    fit_x, fit_y = np.concatenate(x[:2]), np.concatenate(y[:2])
    every = np.concatenate(y)
    if len(set(fit_y.tolist())) < 2:
        return Model(lexicons[2], None, (np.zeros(1), np.zeros(1)), float(every.mean()) if len(every) else 0.0)
    trees = Trees.fit(fit_x, fit_y)
    held_x, held_y = (x[2], y[2]) if len(set(y[2].tolist())) == 2 else (fit_x, fit_y)
    return Model(lexicons[2], trees, isotonic(trees.raw(held_x), held_y), float(every.mean()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_LEXICON and the number of trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)), pa.float64())], names=["doc_id", "score"])
        shared.value.words.known.clear()
        release()

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, score double")


def scored_rows(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(batch.column(at)), pa.float64())], names=names)
        shared.value.words.known.clear()
        release()

    schema = docs.schema
    names = [*docs.columns, "_score"]
    return docs.mapInArrow(run, type(schema)([*schema.fields]).add("_score", "double"))
