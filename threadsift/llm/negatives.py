"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

Vectors are made whole numbers and sorted by label and by the place of their most variable dimensions on a Hilbert curve.
Runs of them are written as blocks, one Parquet row each, with the least and greatest value of every dimension. For an
anchor and a block, interval arithmetic over these zones bounds every inner product from both sides. An anchor's block of
its own gives a first bar for its positives; only blocks of its label whose upper bound reaches that bar are read for
them. Each positive then opens a window of scores for negatives, and of the other labels only blocks whose bounds
meet a window are read. Within a task blocks come in the order of their upper bounds, and an anchor leaves out those that can
no longer beat what it has. The bounds are exact, so nothing is lost by what is not read.

Anchors are cut into tiles and blocks into groups; a task scores one tile against one group and keeps the few best of
each window. Neither passes through the driver or is broadcast, and memory is bounded by a tile, a group and a
block's scores. How much the zones spare depends on the data: independent dimensions spare nothing (README).

Defined results: rows with a NULL label, a NULL vector or a NULL or non-finite component take no part; a shorter vector is filled up with
zeros, an empty one scores 0 with all; rows are told apart by their place, so repeated rows are others of each other; a
NULL vec_id is no anchor and comes last among ties; an anchor without positives, or a window without rows, gives no
row; an empty table gives none; vectors whose scores could exceed 64 bits are refused; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadsift.llm.tables import settled, small_side

POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these hundredths of its positive.
LOW, HIGH = 50, 95
#: Rows in a block, blocks in a group, anchors in a tile, at most or about.
BLOCK, GROUP, TILE = 256, 256, 32_768
HILBERT_BITS = 64
_NO_ID = np.iinfo(np.int64).max
_NONE = -(1 << 62)


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite, F.lit(False))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below 2**bits, as unsigned 64-bit numbers."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    for q in (np.uint64(1 << b) for b in range(bits - 1, 0, -1)):
        low = q - np.uint64(1)
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for q in (np.uint64(1 << b) for b in range(bits - 1, 0, -1)):
        turned ^= np.where((x[n - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
    x ^= turned
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key


@dataclass(frozen=True)
class Shape:
    """What all tasks need to know of the vectors."""

    dimensions: int
    stored: str  # type of a component in blocks
    exact: str  # type in which inner products are exact
    axes: tuple[int, ...]  # dimensions on the curve
    low: tuple[int, ...]
    high: tuple[int, ...]

    def rows(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), self.stored).reshape(-1, max(self.dimensions, 1)).astype(self.exact)


def _padded(column: pa.Array, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def shape_of(rows: DataFrame) -> Shape | None:
    """One row for each dimension comes to the driver, from sums that each task has taken."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            width = max(1, int(column.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)))
            x = _padded(column, width)
            f = x.astype(float)
            yield pa.RecordBatch.from_pydict(
                {"d": np.arange(width), "n": np.full(width, len(x)), "lo": x.min(0), "hi": x.max(0), "s": f.sum(0), "ss": (f * f).sum(0)}
            )

    kind = "d long, n long, lo long, hi long, s double, ss double"
    found = rows.select("q").mapInArrow(sums, kind).groupBy("d").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"), F.sum("ss").alias("ss")
    ).orderBy("d").collect()
    if not found:
        return None
    most = max(max(-r["lo"], r["hi"], 0) for r in found)
    bound = len(found) * most * most
    if 100 * bound >= 1 << 62:
        raise ValueError("components are too large for scores of 64 bits")
    spread = [r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2 for r in found]
    axes = tuple(sorted(sorted(range(len(found)), key=lambda d: -spread[d])[:16]))
    return Shape(
        len(found), "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64",
        "float32" if bound < 1 << 24 else "float64" if bound < 1 << 53 else "int64",
        axes, tuple(min(found[d]["lo"], 0) for d in axes), tuple(max(found[d]["hi"], 0) for d in axes),
    )


def blocks_of(rows: DataFrame, shape: Shape, block_rows: int = BLOCK) -> DataFrame:
    """(block, label, ids, vecs, lo, hi): rows (vec_id, label, q) in the order of label and curve, in blocks of one label."""
    bits = min(16, HILBERT_BITS // len(shape.axes))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, span = np.array(shape.low), np.maximum(1, np.array(shape.high) - np.array(shape.low)).astype(float)
        for batch in batches:
            x = _padded(batch.column(2), shape.dimensions)
            cells = np.clip((x[:, shape.axes] - low) / span * (1 << bits), 0, (1 << bits) - 1)
            keys = (hilbert_keys(cells, bits) ^ np.uint64(1 << 63)).astype(np.int64)
            vecs = [r.tobytes() for r in x.astype(shape.stored)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.array(vecs, pa.binary())], names=["vec_id", "label", "key", "vec"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("ids", pa.list_(pa.int64())), ("vecs", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary())])
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            ends = np.unique(np.concatenate((np.flatnonzero(np.diff(labels)) + 1, [0, len(labels)])))
            cuts = [(i, min(i + block_rows, b)) for a, b in zip(ends[:-1], ends[1:], strict=True) for i in range(a, b, block_rows)]
            ids, vecs, out = batch.column(0), batch.column(3).to_pylist(), []
            for a, b in cuts:
                x = np.frombuffer(b"".join(vecs[a:b]), shape.stored).reshape(b - a, -1)
                out.append((number, int(labels[a]), ids[a:b].to_pylist(), x.tobytes(), x.min(0).tobytes(), x.max(0).tobytes()))
                number += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    keyed = rows.select("vec_id", "label", "q").mapInArrow(placed, "vec_id long, label long, key long, vec binary")
    order = ["label", "key", "vec_id"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return settled(ranged.mapInArrow(packed, "block long, label long, ids array<long>, vecs binary, lo binary, hi binary"), "blocks")


def _ids(values: list) -> np.ndarray:
    return np.array([_NO_ID if v is None else v for v in values], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, kept: tuple[np.ndarray, np.ndarray]) -> None:
    """Takes the scores (anchors by rows, rows by ascending id) of each window into the best so far, in place.

    ``kept``: scores and ids, anchors by windows by ``most``, best first.
    """
    for w in range(low.shape[1]):
        inside = np.where((scores >= low[:, w, None]) & (scores <= high[:, w, None]), scores, _NONE)
        for a in np.flatnonzero(inside.max(axis=1) >= np.maximum(kept[0][:, w, -1], _NONE + 1)):
            own = inside[a]
            top = np.argsort(-own, kind="stable")[:most]
            top = top[own[top] > _NONE]
            s = np.concatenate((kept[0][a, w], own[top].astype(np.int64)))
            i = np.concatenate((kept[1][a, w], ids[top]))
            first = np.lexsort((i, -s))[:most]
            kept[0][a, w], kept[1][a, w] = s[first], i[first]


def _empty(anchors: int, windows: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((anchors, windows, most), _NONE, np.int64), np.full((anchors, windows, most), _NO_ID, np.int64)


def anchors_of(blocks: DataFrame, shape: Shape, every: int, positives: int = POSITIVES) -> DataFrame:
    """(block, at, vec_id, label, vec, scores, ids): rows whose vec_id is a multiple of ``every``, with the best others of their
    own block."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, label, ids, vecs in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                x, ids = shape.rows([vecs]), _ids(ids)
                at = np.flatnonzero((ids % every == 0) & (ids != _NO_ID))
                order = np.argsort(ids, kind="stable")
                for a in at:
                    others = order[order != a]
                    kept = _empty(1, 1, positives)
                    if len(others):
                        open_ = np.array([[_NONE + 1]]), np.array([[-_NONE]])
                        _best((x[others] @ x[a])[None].astype(np.int64), ids[others], *open_, positives, kept)
                    n = int((kept[0] > _NONE).sum())
                    mine = [None if i == _NO_ID else int(i) for i in kept[1][0, 0, :n]]
                    out.append((block, int(a), int(ids[a]), label, x[a].astype(shape.stored).tobytes(), kept[0][0, 0, :n].tolist(), mine))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    names = ["block", "at", "vec_id", "label", "vec", "scores", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    kind = "block long, at long, vec_id long, label long, vec binary, scores array<long>, ids array<long>"
    return settled(blocks.select("block", "label", "ids", "vecs").mapInArrow(found, kind), "anchors")


@dataclass(frozen=True)
class _Tile:
    """The anchors of a task, in a fixed order, and the windows that they look into."""

    home: np.ndarray
    at: np.ndarray
    label: np.ndarray
    vec: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(table: pa.Table, shape: Shape) -> _Tile:
        home, at = (np.asarray(table.column(c)) for c in ("block", "at"))
        order = np.lexsort((at, home))
        table = table.take(order)
        low, high = (np.array(table.column(c).to_pylist(), np.int64).reshape(len(order), -1) for c in ("low", "high"))
        return _Tile(home[order], at[order], np.asarray(table.column("label")), shape.rows(table.column("vec").to_pylist()), low, high)

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of each anchor with a vector of each zone."""
        up, down = np.maximum(self.vec, 0), np.minimum(self.vec, 0)
        return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def search(anchors: DataFrame, blocks: DataFrame, shape: Shape, same_label: bool, most: int) -> DataFrame:
    """(block, at, window, score, id): for each window of each anchor the ``most`` best rows of each group of blocks, other than its
    own block, with its label or without it. ``anchors`` have ``low`` and ``high``, the windows."""
    n_anchors, n_blocks = anchors.count(), blocks.select("block").count()
    tiles = max(1, -(-n_anchors // TILE))
    wide = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = max(-(-n_blocks // GROUP), min(n_blocks, wide), 1)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiled = anchors.select("*", F.pmod(F.xxhash64("block", "at"), F.lit(tiles)).cast("int").alias("tile"), each(cut).alias("part"))
    dealt = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(cut)).cast("int"))
    zones = dealt.select("block", "label", "lo", "hi", "part", each(tiles).alias("tile"))

    def wanted(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("tile", pa.int32()), ("block", pa.int64()), ("need", pa.binary())])
        if not len(left) or not len(right):
            return schema.empty_table()
        tile = _Tile.of(left, shape)
        block, label = (np.asarray(right.column(c)) for c in ("block", "label"))
        least, greatest = tile.bounds(*[shape.rows(right.column(c).to_pylist()) for c in ("lo", "hi")])
        need = np.zeros(least.shape, bool)
        for w in range(tile.low.shape[1]):
            open_ = (tile.low[:, w] <= tile.high[:, w])[:, None]
            need |= open_ & (greatest >= tile.low[:, w, None]) & (least <= tile.high[:, w, None])
        need &= ((tile.label[:, None] == label) == same_label) & (tile.home[:, None] != block)
        some = np.flatnonzero(need.any(axis=0))
        bits = [np.packbits(need[:, b]).tobytes() for b in some]
        return pa.table([pa.array(np.full(len(some), left.column("tile")[0].as_py(), np.int32)), pa.array(block[some]), pa.array(bits, pa.binary())], schema=schema)

    keys = ["tile", "part"]
    asked = settled(tiled.groupBy(*keys).cogroup(zones.groupBy(*keys)).applyInArrow(wanted, "tile int, block long, need binary"), "asked")
    read = dealt.join(small_side(asked, F.octet_length("need") / 8), "block")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
        if not len(left) or not len(right):
            return schema.empty_table()
        tile = _Tile.of(left, shape)
        need = np.stack([np.unpackbits(np.frombuffer(b, np.uint8), count=len(tile.home)).astype(bool) for b in right.column("need").to_pylist()])
        _, greatest = tile.bounds(*[shape.rows(right.column(c).to_pylist()) for c in ("lo", "hi")])
        kept = _empty(len(tile.home), tile.low.shape[1], most)
        for b in np.argsort(-greatest.max(axis=0), kind="stable"):
            # an anchor goes on with a block that can still bring a better row, or an equal one of a smaller id
            bar = np.where(tile.low <= tile.high, np.maximum(kept[0][:, :, -1], tile.low), -_NONE).min(axis=1)
            who = np.flatnonzero(need[b] & (greatest[:, b] >= bar))
            if not len(who):
                continue
            ids = _ids(right.column("ids")[b].as_py())
            order = np.argsort(ids, kind="stable")
            x = shape.rows([right.column("vecs")[b].as_py()])[order]
            own = kept[0][who], kept[1][who]
            _best((tile.vec[who] @ x.T).astype(np.int64), ids[order], tile.low[who], tile.high[who], most, own)
            kept[0][who], kept[1][who] = own
        a, w, k = np.nonzero(kept[0] > _NONE)
        ids = kept[1][a, w, k]
        columns = [pa.array(tile.home[a]), pa.array(tile.at[a]), pa.array(w.astype(np.int32)), pa.array(kept[0][a, w, k]), pa.array(ids, mask=ids == _NO_ID)]
        return pa.table(columns, schema=schema)

    scores = "block long, at long, window int, score long, id long"
    return tiled.groupBy(*keys).cogroup(read.groupBy(*keys)).applyInArrow(scored, scores)


def _first(rows: DataFrame, by: list[str], most: int, rank: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return rows.withColumn(rank, place).filter(F.col(rank) <= most)


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, label, q)."""
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    shape = shape_of(rows)
    if shape is None:
        return rows.sparkSession.createDataFrame([], kind)
    blocks = blocks_of(rows, shape)
    anchors = anchors_of(blocks, shape, every, positives)
    full = F.size("scores") >= positives
    bar = F.when(full, F.element_at("scores", -1)).otherwise(F.lit(_NONE + 1))
    opened = anchors.select("block", "at", "label", "vec", F.array(bar).alias("low"), F.array(F.lit(-_NONE)).alias("high"))
    found = search(opened, blocks, shape, True, positives).select("block", "at", "score", "id")
    home = anchors.select("block", "at", F.inline(F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("id"))))
    near = settled(_first(found.unionByName(home), ["block", "at"], positives, "place"), "positives")

    # one window for each positive, best first; an anchor with fewer gets windows that hold nothing
    score = F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"])
    scored = near.groupBy("block", "at").agg(score.alias("_s"))
    ends = lambda edge: F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: edge(F.try_element_at("_s", k)))
    floor = lambda x: F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))
    lows = ends(lambda s: F.coalesce(-floor(-s * low), F.lit(1).cast("long")))
    highs = ends(lambda s: F.coalesce(floor(s * high), F.lit(0).cast("long")))
    opened = anchors.join(scored, ["block", "at"]).select("block", "at", "label", "vec", lows.alias("low"), highs.alias("high"))
    found = search(settled(opened, "windows"), blocks, shape, False, negatives)
    best = _first(found, ["block", "at", "window"], negatives, "rank").select("block", "at", (F.col("window") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(anchors.select("block", "at", F.col("vec_id").alias("anchor_id")), ["block", "at"])
    named = named.withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
    return named.join(best, ["block", "at", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
