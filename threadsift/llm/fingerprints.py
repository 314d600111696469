"""MinHash fingerprints of documents.

The shingles of a text are its runs of five words (of fewer words, all of them as one); each of ``PERMUTATIONS``
universal hash functions permutes the shingles, and the least value of each, cut to 16 bits, makes the fingerprint: a
hex string that equal texts share and of which the share of equal positions estimates the Jaccard similarity.
``near_duplicates`` joins bands of fingerprints in Spark and verifies pairs by the exact Jaccard similarity of their
shingles: members with the first one of their band, then, in bands that this leaves in several components, all members
that are not yet connected, by blocks and pairs of blocks. Two documents are compared in the first band they share.

``edited_neighbours`` compares each document with a version whose tail comes from the next document. The neighbours
come from a sort by range, so a document and its successor are in one task but at the ends of partitions; the first and
last rows of partitions are matched in a second, small step.

Defined results: a NULL or empty text has no shingles and a fingerprint of its own (all ones), alike only to itself;
documents are ordered by doc_id, NULL last, equal ids by text; a single document is its own successor; repeated rows
are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadsift.llm.components import components
from threadsift.llm.hashing import U64, flat, groups, mix, segment_min, shingle_hashes, word_hashes
from threadsift.llm.tables import settled

PERMUTATIONS = 128
SHINGLE_WORDS = 5
BANDS = 32  # of four values each: a pair of similarity 0.75 shares one with probability 1 - 5e-6
SIMILARITY = 0.75
#: Members of a band in a block, about.
BLOCK = 128
_FACTORS = mix(np.arange(1, 1025, dtype=U64)) | U64(1)
_SHIFTS = mix(np.arange(5001, 6025, dtype=U64))


def signatures(data: np.ndarray, offsets: np.ndarray, permutations: int = PERMUTATIONS, k: int = SHINGLE_WORDS) -> np.ndarray:
    """One row of 16-bit values per text."""
    out = np.empty((len(offsets) - 1, permutations), np.uint16)
    for i, j in groups(offsets):
        a, b = offsets[i], offsets[j]
        words, at = word_hashes(data[a:b], offsets[i : j + 1] - a)
        shingles, at = shingle_hashes(words, at, k)
        for p in range(permutations):
            least = segment_min(shingles * _FACTORS[p] + _SHIFTS[p], at, U64(0xFFFFFFFFFFFFFFFF))
            # the least of many values has small high bits, so the kept ones come from all of them
            out[i:j, p] = (mix(least) >> U64(48)).astype(np.uint16)
        out[i:j][np.diff(at) == 0] = 0xFFFF
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _flat_list(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return flat(pa.array([t.encode() for t in texts], pa.large_binary()))


def fingerprinted(docs: DataFrame, permutations: int = PERMUTATIONS) -> DataFrame:
    """(doc_id, fingerprint, bands): bands are hashes of consecutive fingerprint values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = signatures(*flat(batch.column(1)), permutations)
            some = [t is not None and t.strip() != "" for t in batch.column(1).to_pylist()]
            rows = sig.reshape(len(sig), BANDS, -1).astype(U64)
            folded = np.zeros(rows.shape[:2], U64)
            for c in range(rows.shape[2]):
                folded = mix(folded * U64(0x100000001B3) + rows[:, :, c] + U64(1))
            folded = mix(folded + np.arange(BANDS, dtype=U64))
            bands = [b.astype(np.int64) if ok else np.zeros(0, np.int64) for b, ok in zip(folded.view(np.int64), some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes().hex() for r in sig.astype(">u2")]), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "fingerprint", "bands"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, fingerprint string, bands array<long>")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, jaccard) with a < b: links between documents of different texts, and from each document to the first of
    its text. Not every pair is put out: any two documents that share a band and are similar are connected by links.
    The similarity is computed from the shingles themselves."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")
    firsts = base.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    copies = base.join(firsts.withColumnRenamed("doc_id", "a"), "text").filter("a < doc_id and trim(text) <> ''")
    copies = copies.select("a", F.col("doc_id").alias("b"), F.lit(1.0).alias("jaccard"))
    texts = settled(firsts.select(F.col("doc_id").alias("_id"), "text"), "texts")
    prints = settled(fingerprinted(texts.withColumnRenamed("_id", "doc_id")).select("doc_id", "bands"), "bands")
    banded = prints.select("doc_id", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = banded.join(heads, "band").filter("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingle_sets(batch.column(c)) for c in (2, 3)]
            exact = [len(np.intersect1d(x, y, True)) / max(1, len(np.union1d(x, y))) for x, y in zip(*sets, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exact, pa.float64())], names=["a", "b", "jaccard"])

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"a {key}, b {key}, jaccard double"
    checked = both.select("a", "b", "text_a", "text_b").mapInArrow(verify, schema)
    links = settled(checked.filter(F.col("jaccard") >= similarity), "links")
    roots = components(links.select("a", "b")).toDF("_node", "_root")
    known = prints.join(roots, F.col("doc_id") == F.col("_node"), "left")
    known = settled(known.select("doc_id", F.coalesce("_root", "doc_id").alias("root"), "bands"), "known")
    members = known.select("doc_id", F.explode("bands").alias("band"), "root")
    bands = members.groupBy("band").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    bands = bands.filter("n > 2 and _a <> _b").select(F.col("band").alias("_band"), blocks.alias("blocks"))
    dealt = members.join(bands, F.col("band") == F.col("_band"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("doc_id", "band"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("doc_id", "band", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own")
    dealt = dealt.join(known.select(F.col("doc_id").alias("_known"), "root", "bands"), F.col("doc_id") == F.col("_known"))
    dealt = dealt.join(texts, F.col("doc_id") == F.col("_id"))
    # streamed by pairs of blocks, so a task holds two blocks at a time
    dealt = dealt.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two")
    dealt = dealt.select("band", "one", "two", "own", "doc_id", "root", "bands", "text")
    more = dealt.mapInArrow(_within_blocks(similarity), schema)
    return copies.unionByName(links).unionByName(more)


def _within_blocks(similarity: float):
    """Links between members of a block, or of two, that are not yet connected; rows come sorted by pairs of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            where = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
            cuts = [0, *(i for i in range(1, len(where)) if where[i] != where[i - 1]), len(where)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if where[i] != now and held:
                    yield _linked(held, similarity)
                    held = []
                now = where[i]
                held.append(batch.slice(i, j - i))
        if held:
            yield _linked(held, similarity)

    return run


def _linked(held: list[pa.RecordBatch], similarity: float) -> pa.RecordBatch:
    part = pa.Table.from_batches(held)
    band, own = part.column(0)[0].as_py(), part.column(3).to_numpy()
    ids, roots = part.column(4).to_pylist(), part.column(5).to_pylist()
    names = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    root = np.array([names[r] for r in roots], np.int64)
    bands = np.array(part.column(6).to_pylist(), np.int64)
    one_block = part.column(1)[0].as_py() == part.column(2)[0].as_py()
    sets = _shingle_sets(part.column(7))
    sizes = np.array([len(x) for x in sets], np.int64)
    shingles, number = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(sizes)))
    has = np.zeros(len(shingles), bool)
    out: list[tuple] = []
    for i in range(len(ids) - 1):
        others = np.arange(i + 1, len(ids))
        others = others[(root[others] != root[i]) & (one_block | (own[others] != own[i]))]
        same = bands[others] == bands[i]
        # the first band that both have; this one is among them
        others = others[bands[i][same.argmax(1)] == band]
        least, most = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[least / most >= similarity]
        if not len(others):
            continue
        has[number[at[i] : at[i + 1]]] = True
        for j in others.tolist():
            if root[j] != root[i]:
                common = int(has[number[at[j] : at[j + 1]]].sum())
                exact = common / max(1, int(sizes[i] + sizes[j]) - common)
                if exact >= similarity:
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j]), exact))
                    root[root == root[j]] = root[i]
        has[number[at[i] : at[i + 1]]] = False
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    kind = part.schema.field(4).type
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], kind), pa.array(columns[2], pa.float64())], names=["a", "b", "jaccard"])


def _shingle_sets(column: pa.Array) -> list[np.ndarray]:
    data, offsets = flat(column)
    out: list[np.ndarray] = []
    for i, j in groups(offsets):
        words, at = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        hashes, at = shingle_hashes(words, at, SHINGLE_WORDS)
        out += [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def _edited(text: str, following: str) -> str:
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


def _compared(keys: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    edited = [_edited(t, n) for t, n in zip(texts, following, strict=True)]
    changed = signatures(*_flat_list(edited)) if edited else np.zeros((0, PERMUTATIONS), np.uint16)
    columns = [
        pa.array(keys, pa.string()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([r.tobytes().hex() for r in own.astype(">u2")], pa.string()),
        pa.array([r.tobytes().hex() for r in changed.astype(">u2")], pa.string()),
        pa.array(likeness(own, changed), pa.float64()),
        pa.array(likeness(own, after), pa.float64()),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of a sorted partition with the next one; the last row is left to the second step."""
    key, text, own = None, None, None
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        for i, j in groups(at):
            some_keys, some, sig = keys[i:j], texts[i:j], signatures(*_flat_list(texts[i:j]))
            if text is not None:
                some_keys, some, sig = [key, *some_keys], [text, *some], np.concatenate((own, sig))
            key, text, own = some_keys[-1], some[-1], sig[-1:]
            yield _compared(some_keys[:-1], some[:-1], some[1:], sig[:-1], sig[1:])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = first or (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            last = (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
    if first:
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), *(pa.array([v], pa.string()) for v in (*first, *last))],
            names=["part", "first_id", "first_text", "last_id", "last_text"],
        )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts, following = (batch.column(c).to_pylist() for c in range(3))
        if keys:
            yield _compared(keys, texts, following, signatures(*_flat_list(texts)), signatures(*_flat_list(following)))


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    parts = rows.repartitionByRange(F.col("doc_id").asc_nulls_last()).sortWithinPartitions(*order)
    parts = parts.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    schema = (
        "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    inner = parts.mapInArrow(_in_order, schema)
    ends = parts.mapInArrow(_ends, "part int, first_id string, first_text string, last_id string, last_text string")
    by_part = Window.orderBy("part")  # one row per partition
    following = F.coalesce(F.lead("first_text").over(by_part), F.first("first_text").over(by_part))
    outer = ends.select("last_id", "last_text", following.alias("following")).mapInArrow(_pairs, schema)
    return inner.unionByName(outer).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
