"""Sharding by minimum-cost flow: a stored layout is brought to new capacities by moving the fewest bytes.

``store`` writes documents as an existing layout, a folder per old shard. ``reshard`` sums that layout by blocks (runs of
rows of one file) and solves, from the sizes of the old shards and the capacities of the new ones, a flow in which a byte
that stays in its shard costs nothing and a moved one costs one (or what a matrix says). Each old shard keeps its first
blocks; the others go whole to the shards that the flow names. A block in which a transfer begins or ends is cut
between rows, the largest rows first, so that sizes come out even to about the smallest documents of the block. Only
files that lose rows are written anew; the others stay where they are, and ``read_layout`` reads both.

The law is ``bytes``: sizes near equal. Equal texts form no groups here, as nothing asks that copies stay together.

The driver sees one row per block: at most ``MOST_BLOCKS`` and one per file more, as in Spark's own listing of the files.
Rows never pass through it; the rows of a cut block are dealt out in one task, at most ``MOST_BLOCKS``-th of the table.
The solver is dense, for up to some hundreds of shards.

Defined results: a NULL text has no bytes, so its row has size 1 and the CRC of nothing; empty texts likewise; repeated rows are
rows of their own; rows are told apart by their place in a file, so neither NULL nor equal doc_ids matter; a text
longer than a capacity makes its shard larger by that much; an empty table gives an empty layout; columns of the
documents are kept in a struct, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.llm.tables import settled, small_side
from threadsift.sources.scratch import scratch_folder

LAW = "bytes"
#: Rows in a block, at least, and blocks of the whole table, at most (a file's last block may be shorter).
BLOCK_ROWS = 1000
MOST_BLOCKS = 32_768
_FAR = 1 << 60


@dataclass(frozen=True)
class Resharded:
    """The new layout: files of the old one that stay, and what was written anew."""

    old_root: str
    new_root: str
    schema: T.StructType
    per_block: int
    moved_bytes: int
    flow: np.ndarray
    kept_files: list[str]
    rewritten_files: list[str]
    blocks: DataFrame | None


def size_of(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def store(docs: DataFrame, shard: Column, path: str) -> T.StructType:
    """Writes ``docs`` as a layout with a folder per old shard and returns the schema to read it with."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(shard.cast("int").alias("old"), size_of(F.col("text")).alias("size"), own)
    rows.write.partitionBy("old").parquet(path)
    return rows.select("size", "doc", "old").schema


def _read(spark: SparkSession, root: str, schema: T.StructType, files: Sequence[str] | None = None) -> DataFrame:
    """Rows of a stored layout with the file and the place that they come from."""
    reader = spark.read.schema(schema).option("basePath", root)
    rows = reader.parquet(root) if files is None else reader.parquet(*files)
    return rows.select("old", "size", "doc", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def even(total: int, shards: int) -> list[int]:
    """Capacities that differ by one byte at most."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def transfers(sizes: Sequence[int], capacities: Sequence[int], cost: np.ndarray | None = None) -> np.ndarray:
    """Bytes from each old shard to each new one, at the least total cost, by successive shortest paths.

    The capacities hold all bytes. Without a matrix of costs every byte that changes its shard costs one.
    """
    left, room = np.array(sizes, np.int64), np.array(capacities, np.int64)
    if left.sum() > room.sum():
        raise ValueError("the new shards hold fewer bytes than there are")
    n, m = len(left), len(room)
    cost = (np.arange(n)[:, None] != np.arange(m)).astype(np.int64) if cost is None else np.asarray(cost, np.int64)
    flow = np.zeros((n, m), np.int64)
    while left.any():
        to_old, back = np.where(left > 0, 0, _FAR), np.full(n, -1)
        to_new, way_in = np.full(m, _FAR), np.full(m, -1)
        while True:
            ahead = to_old[:, None] + cost
            nearer = ahead.min(axis=0) < to_new
            to_new, way_in = np.where(nearer, ahead.min(axis=0), to_new), np.where(nearer, ahead.argmin(axis=0), way_in)
            returned = np.where(flow > 0, to_new - cost, _FAR)
            nearer = returned.min(axis=1) < to_old
            if not nearer.any():
                break
            to_old, back = np.where(nearer, returned.min(axis=1), to_old), np.where(nearer, returned.argmin(axis=1), back)
        end = at = int(np.where(room > 0, to_new, 2 * _FAR).argmin())
        path = []
        while True:
            o = int(way_in[at])
            path.append((o, at, 1))
            if back[o] < 0:
                break
            at = int(back[o])
            path.append((o, at, -1))
        amount = min(left[o], room[end], *[flow[a, b] for a, b, way in path if way < 0])
        for a, b, way in path:
            flow[a, b] += way * amount
        left[o] -= amount
        room[end] -= amount
    return flow


def _deal(blocks: list, flow: np.ndarray) -> tuple[list[int | None], dict[int, list[tuple[int, int]]]]:
    """The new shard of each block, None for a cut one, and of those the bytes for each shard in turn."""
    whole: list[int | None] = []
    cut: dict[int, list[tuple[int, int]]] = {}
    old, queue = None, []
    for k, b in enumerate(blocks):
        if b["old"] != old:
            old = b["old"]
            order = sorted(range(flow.shape[1]), key=lambda s: (s != old, s))
            queue = [[s, int(flow[old, s])] for s in order if flow[old, s]]
        need, parts = b["bytes"], []
        while need:
            part = min(need, queue[0][1])
            parts.append((queue[0][0], part))
            need -= part
            queue[0][1] -= part
            if not queue[0][1]:
                queue.pop(0)
        whole.append(parts[0][0] if len(parts) == 1 else None)
        if len(parts) > 1:
            cut[k] = parts
    return whole, cut


def _cut(table: pa.Table) -> pa.Table:
    """Rows of one cut block to shards: each takes the largest rows that still fit, the last takes the rest."""
    row, size = (np.asarray(table.column(c)) for c in ("row", "size"))
    shards, amounts = table.column("shards")[0].as_py(), table.column("amounts")[0].as_py()
    order = np.lexsort((row, -size))
    shard = np.full(len(row), shards[-1])
    taken = np.zeros(len(row), bool)
    for s, amount in zip(shards[:-1], amounts[:-1], strict=True):
        for i in order:
            if not taken[i] and size[i] <= amount:
                taken[i], shard[i] = True, s
                amount -= size[i]
    place = np.zeros(len(row), np.int64)
    for s in set(shards):
        own = np.flatnonzero(shard == s)
        place[own[np.argsort(row[own])]] = np.arange(len(own))
    return pa.table(
        {"old": table.column("old"), "file": table.column("file"), "block": table.column("block"), "row": row, "size": size,
         "shard": pa.array(shard, pa.int32()), "place": place}
    )


def reshard(
    spark: SparkSession, old_root: str, schema: T.StructType, shards: int, cost: np.ndarray | None = None, block_rows: int = BLOCK_ROWS
) -> Resharded:
    """Brings a stored layout to ``shards`` shards of near equal sizes and writes the affected files anew."""
    old = _read(spark, old_root, schema)
    per_block = max(block_rows, -(-old.count() // MOST_BLOCKS))
    block = F.floor(F.col("row") / per_block).alias("block")
    sums = old.select("old", "file", block, "size").groupBy("old", "file", "block")
    blocks = sums.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    blocks.sort(key=lambda b: (b["old"], b["file"], b["block"]))
    sizes = np.zeros(max([shards, *[b["old"] + 1 for b in blocks]]), np.int64)
    for b in blocks:
        sizes[b["old"]] += b["bytes"]
    flow = transfers(sizes, even(int(sizes.sum()), shards), cost)
    whole, cut = _deal(blocks, flow)

    cut_rows, counts, moved = None, {}, 0
    if cut:
        asked = [(blocks[k]["old"], blocks[k]["file"], blocks[k]["block"], [s for s, _ in p], [a for _, a in p]) for k, p in cut.items()]
        wanted = spark.createDataFrame(asked, "old int, file string, block long, shards array<int>, amounts array<long>")
        files = sorted({f"{old_root}/old={a[0]}/{a[1]}" for a in asked})
        rows = _read(spark, old_root, schema, files).select("old", "file", block, "row", "size").join(F.broadcast(wanted), ["old", "file", "block"])
        kind = "old int, file string, block long, row long, size long, shard int, place long"
        cut_rows = settled(rows.groupBy("old", "file", "block").applyInArrow(_cut, kind), "cut")
        for r in cut_rows.groupBy("old", "file", "block", "shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).collect():
            counts[r["old"], r["file"], r["block"], r["shard"]] = r["rows"]
            moved += r["bytes"] if r["shard"] != r["old"] else 0

    next_slot, placed, pieces, touched = [0] * shards, [], [], set()
    # a shard's own blocks come first, so that files that stay keep their places when others join
    for k in sorted(range(len(blocks)), key=lambda k: (whole[k] != blocks[k]["old"], k)):
        b = blocks[k]
        at = (b["old"], b["file"], b["block"])
        if whole[k] is not None:
            placed.append((*at, whole[k], next_slot[whole[k]]))
            next_slot[whole[k]] += b["rows"]
            moved += b["bytes"] if whole[k] != b["old"] else 0
        for s in sorted({s for s, _ in cut.get(k, ())}):
            pieces.append((*at, s, next_slot[s]))
            next_slot[s] += counts.get((*at, s), 0)
        if whole[k] != b["old"]:
            touched.add((b["old"], b["file"]))
    path = lambda f: f"{old_root}/old={f[0]}/{f[1]}"
    kept = sorted(path(f) for f in {(b["old"], b["file"]) for b in blocks} - touched)
    rewritten = sorted(map(path, touched))
    found = Resharded(old_root, scratch_folder(spark, "shards"), schema, per_block, int(moved), flow, kept, rewritten, None)
    if placed:
        table = spark.createDataFrame(placed, "old int, file string, block long, shard int, base long").repartition(1)
        found = replace(found, blocks=settled(table, "blocks"))
    if not rewritten:
        return found
    rows = _read(spark, old_root, schema, rewritten)
    out = [_whole_blocks(found, rows)] if placed else []
    if cut_rows is not None:
        bases = F.broadcast(spark.createDataFrame(pieces, "old int, file string, block long, shard int, base long"))
        dealt = cut_rows.join(bases, ["old", "file", "block", "shard"])
        dealt = small_side(settled(dealt.select("old", "file", "row", "shard", (F.col("base") + F.col("place")).alias("slot")), "dealt"))
        parts = _read(spark, old_root, schema, files)
        out.append(parts.join(dealt, ["old", "file", "row"]).select("old", "size", "doc", "shard", "slot"))
    reduce(DataFrame.unionByName, out).write.partitionBy("shard").parquet(found.new_root)
    return found


def _whole_blocks(layout: Resharded, rows: DataFrame) -> DataFrame:
    """The rows of blocks that were not cut, with their shards and slots; a block's rows keep their order."""
    near = rows.withColumn("block", F.floor(F.col("row") / layout.per_block)).join(small_side(layout.blocks), ["old", "file", "block"])
    within = F.col("row") - F.col("block") * layout.per_block
    return near.select("old", "size", "doc", "shard", (F.col("base") + within).alias("slot"))


def read_layout(spark: SparkSession, layout: Resharded) -> DataFrame:
    """All rows of the new layout (old, size, doc, shard, slot): files that stayed and files written anew."""
    kind = T.StructType([*layout.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    new = spark.read.schema(kind).parquet(layout.new_root) if layout.rewritten_files else spark.createDataFrame([], kind)
    new = new.select("old", "size", "doc", "shard", "slot")
    if not layout.kept_files:
        return new
    return new.unionByName(_whole_blocks(layout, _read(spark, layout.old_root, layout.schema, layout.kept_files)))
