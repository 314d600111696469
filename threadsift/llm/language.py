"""Language identification by error-correcting output codes.

Every language has a codeword of bits; for each bit a binary classifier over hashed byte n-grams tells the languages
with a one from those with a zero (its weights are the log ratios of smoothed n-gram frequencies). A text's margins are
decoded to the codeword with the least sum of logistic losses, each weighted by how well its bit was predicted on the
training rows. The score is the share of the chosen codeword in the softmax of negative losses; a text is flagged as
ambiguous if the runner-up is close.

Training uses at most ``MAX_TRAINING_DOCS`` documents of each language, those with the least hash of doc_id, and their
whole texts. Prediction reads every byte of every text.

Defined results: a text that is NULL or has no letter is ``und`` with score 0; ties go to the first language in
alphabetical order; documents without a language are not learned from; with no training rows all is ``und``, with one
language every text with a letter has it, with score 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.hashing import LOWER, flat, groups, segment_sum

MAX_TRAINING_DOCS = 4000
DIMENSIONS = 1 << 15
#: Tasks that count n-grams of the training rows, so many count vectors reach the driver for each language.
TRAINING_TASKS = 24
_SMOOTHING = 0.5


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the one-, two- and three-byte strings that begin at each byte, as one column each."""
    low = LOWER[data].astype(np.uint32)
    low = np.where((data < 65) & (data != 39), np.uint32(32), low)  # digits and marks tell little
    padded = np.concatenate((low, np.full(2, 32, np.uint32)))
    two = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77)
    three = two + padded[2:] * np.uint32(0xC2B2AE3D)
    fold = lambda x, seed: ((x * np.uint32(0x27D4EB2F) + np.uint32(seed)) >> np.uint32(17)).astype(np.int64)
    return np.stack([fold(padded[:-2] * np.uint32(0x165667B1), 1), fold(two, 77), fold(three, 0x51ED27)], 1)


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A 0/1 matrix, one row per language: all splits for up to five languages, else the best of seeded draws."""
    if languages <= 5:
        splits = [s for s in product((0, 1), repeat=languages) if s[0] and 0 in s]
        return np.array(splits, np.int8).T.reshape(languages, -1)
    rng, bits = np.random.default_rng(seed), 8 * int(np.ceil(np.log2(languages)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (languages, bits), dtype=np.int8)
        code[:, code.min(0) == code.max(0)] = rng.permutation(languages)[:, None] % 2
        near = min(int((code[i] != code[j]).sum()) for i in range(languages) for j in range(i))
        if near > apart:
            best, apart = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # dimensions x bits
    trust: np.ndarray  # by bit

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text and bit: mean weight of its n-grams, times a factor that grows with the text's length."""
        found = grams(data)
        n = np.maximum(1, np.diff(offsets))
        out = np.empty((len(offsets) - 1, self.code.shape[1]))
        for bit in range(self.code.shape[1]):
            own = np.ascontiguousarray(self.weights[:, bit])
            out[:, bit] = segment_sum(own[found[:, 0]] + own[found[:, 1]] + own[found[:, 2]], offsets) / n
        return out * np.sqrt(np.minimum(n, 400))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score, and whether the runner-up is close."""
        if len(self.languages) == 1:
            n = len(margins)
            return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
        signs = np.where(self.code == 1, 1.0, -1.0)
        losses = np.stack([(np.logaddexp(0, -margins * s) * self.trust).sum(1) for s in signs], 1)
        best = losses.argmin(1)
        share = np.exp(losses.min(1, keepdims=True) - losses)
        score = 1 / share.sum(1)
        return best, score, score < 0.75


def _counted(languages: list[str]):
    index = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), DIMENSIONS))
        for batch in batches:
            data, offsets = flat(batch.column(0))
            own = [index[x] for x in batch.column(1).to_pylist()]
            for i, lang in enumerate(own):
                for a in range(offsets[i], offsets[i + 1], 1 << 20):
                    found = grams(data[a : min(a + (1 << 20), offsets[i + 1])])
                    counts[lang] += np.bincount(found.ravel(), minlength=DIMENSIONS)
        rows = np.flatnonzero(counts.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array([counts[r].astype("<f8").tobytes() for r in rows], pa.binary())], names=["lang", "counts"]
        )

    return run


def _hits(model: Model):
    index = {x: i for i, x in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n = np.zeros(model.code.shape[1]), 0
        for batch in batches:
            data, offsets = flat(batch.column(0))
            own = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for i, j in groups(offsets):
                margins = model.margins(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                right += ((margins > 0) == (model.code[own[i:j]] == 1)).sum(0)
                n += j - i
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([right.tolist()], pa.list_(pa.float64()))], names=["n", "right"])

    return run


def train(rows: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model | None:
    """Learns from (doc_id, text, lang)."""
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    # about max_docs of each language; hashes are even, so a share of them is a share of the rows
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (place < int(1_000_000 * min(1.0, max_docs / n)) + 1))
    sample = known.filter(chosen).select("text", "lang").repartition(TRAINING_TASKS)
    totals = np.zeros((len(languages), DIMENSIONS))
    for r in sample.mapInArrow(_counted(languages), "lang int, counts binary").collect():
        totals[r["lang"]] += np.frombuffer(r["counts"], "<f8")
    shares = totals / np.maximum(1, totals.sum(1, keepdims=True))
    code = codewords(len(languages))
    weights = np.zeros((DIMENSIONS, code.shape[1]), np.float32)
    tiny = _SMOOTHING / max(1.0, totals.sum(1).mean())
    for bit in range(code.shape[1]):
        one, zero = shares[code[:, bit] == 1].mean(0), shares[code[:, bit] == 0].mean(0)
        weights[:, bit] = np.clip(np.log(one + tiny) - np.log(zero + tiny), -3, 3)
    model = Model(languages, code, weights, np.ones(code.shape[1]))
    if code.shape[1]:
        seen, right = 0, np.zeros(code.shape[1])
        for r in sample.mapInArrow(_hits(model), "n long, right array<double>").collect():
            seen, right = seen + r["n"], right + np.array(r["right"])
        rate = np.clip(right / max(1, seen), 0.5, 0.999)
        model.trust = np.log(rate / (1 - rate)) / np.log(999)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous)."""
    key = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", F.when(letters, F.col("text")).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dimensions x bits, whatever the number of documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.languages, "und"], object)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            none = np.asarray(batch.column(1).is_null())
            best, score, unsure = np.zeros(len(none), np.int64), np.zeros(len(none)), np.zeros(len(none), bool)
            for i, j in groups(offsets):
                margins = _margins(own, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                best[i:j], score[i:j], unsure[i:j] = own.decode(margins)
            best[none], score[none], unsure[none] = len(own.languages), 0.0, True
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(run, f"doc_id {key}, lang_pred string, score double, ambiguous boolean")


def _margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """As ``Model.margins``; a text longer than a step is summed up in steps."""
    most = 1 << 21
    if len(data) <= most or len(offsets) > 2:
        return model.margins(data, offsets)
    total = np.zeros(model.code.shape[1])
    for a in range(0, len(data), most):
        part = data[a : a + most]
        total += model.margins(part, np.array([0, len(part)]))[0] / np.sqrt(min(len(part), 400)) * len(part)
    return (total / len(data) * np.sqrt(min(len(data), 400)))[None, :]
