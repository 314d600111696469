"""Conversation prefix trie with subtree totals by parallel tree contraction.

Conversations are ordered by turn and rebuilt so that those of a block of twenty share their first turns
(``rebuilt_turns``). A node is a distinct sequence of first turns. Its name is the exclusive or of two 64-bit hashes of
(place, role, text) over its turns, so prefixes of a conversation of any length come from running sums that are cut into
chunks; the chance of any confusion among n nodes is below n^2 / 2^128.

``subtree_totals`` alternates two steps until only the root is left. Compress takes every chain of nodes with one child
out at once, by pointer doubling among the chains' nodes, and hangs the node at its lower end to the parent of its upper
end. Rake adds all leaves to their parents. Each phase leaves at most half of the leaves, so there are about as many
phases as the logarithm of the nodes, however deep the trie is. Then the chains are expanded, last phase first: the total
of a node in a chain is that of the lower end and of what lies between. All steps are joins and map-side combined sums of
narrow rows; a hot node costs one row a task, and nothing is gathered but the ids that end at a node, which are hashed in a
stream of pieces.

Defined results: NULL role or text is empty; a NULL turn comes first; equal turns are ordered by role and text; repeated
rows are turns of their own; rows without conv_id belong to no conversation; an empty table has no nodes, not even the root; a
conversation of which the rebuilt form has no turn ends at the root; texts of any length count whole; columns beyond
conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadsift.llm.tables import settled

BLOCK = 20
MOST_SHARED = 3
WORDS = r"[^\x20\x09-\x0D]+"
#: Places of a conversation that one window runs over.
CHUNK = 1024
#: Characters of joined ids in a piece.
PIECE = 1 << 16
_SUMS = ("leaves", "saved")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (c, j, a, b, words), j from 0, with the hashes a and b of their contents, and conversations as (c, h, n,
    lead): the turns taken over, the own ones, and those that were there to take over.

    One sort by range over all turns; a conversation that lies in several ranges is numbered through their counts.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").alias("c"), "turn", text("role"), text("text"))
    order = [F.asc("c"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "c", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("at"),
    )
    ranged = settled(ranged, "turns").withColumn("part", F.shiftright("at", 33))
    spans = ranged.groupBy("c", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = settled(spans.withColumn("before", before), "spans")
    sizes = spans.groupBy("c").agg(F.sum("rows").alias("n"))
    lent = sizes.select(F.col("c").alias("_r"), F.col("n").alias("_lent"))
    with_root = sizes.withColumns({"h": shared_turns(F.col("c")), "r": F.col("c") - F.col("c") % BLOCK}).join(lent, F.col("r") == F.col("_r"), "left")
    lead = F.least("h", F.coalesce("_lent", F.lit(0))).cast("long")
    convs = settled(with_root.select("c", "r", "h", "n", lead.alias("lead")), "convs")
    numbered = ranged.join(spans.select("c", "part", "first", "before"), ["c", "part"])
    return settled(numbered.select("c", (F.col("before") + F.col("at") - F.col("first")).alias("j"), "a", "b", "words"), "numbered"), convs


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: turns as (c, i, a, b, words, last) and conversations as (c, length)."""
    turns, convs = ordered_turns(conversations)
    length = F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.withColumn("length", length)
    own_at = F.col("j") - F.col("h") + F.col("lead")
    own = turns.join(convs, "c").filter("j >= h").select("c", own_at.alias("i"), "a", "b", "words", "length")
    heads = turns.filter(F.col("j") < MOST_SHARED).withColumnRenamed("c", "r")
    taken = convs.filter("lead > 0").join(heads, "r").filter("j < h").select("c", F.col("j").alias("i"), "a", "b", "words", "length")
    rows = own.unionByName(taken)
    last = (F.col("i") == F.col("length") - 1).alias("last")
    return settled(rows.select("c", "i", "a", "b", "words", last), "rebuilt"), convs.select("c", "length")


def _running(rows: DataFrame, chunk: int) -> DataFrame:
    """``rows`` (c, i, e1, e2, ...) with k1 and k2: the exclusive or of e1 and e2 up to this place of c."""
    cut = rows.withColumn("_chunk", F.floor(F.col("i") / chunk))
    within = Window.partitionBy("c", "_chunk").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.withColumns({"k1": F.bit_xor("e1").over(within), "k2": F.bit_xor("e2").over(within)})
    if (rows.agg(F.max("i")).first()[0] or 0) < chunk:
        return out.drop("_chunk")
    sums = cut.groupBy("c", F.col("_chunk").alias("i")).agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"))
    sums = _running(settled(sums, "chunks"), chunk).select(
        "c", F.col("i").alias("_chunk"), F.col("k1").bitwiseXOR(F.col("e1")).alias("_k1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("_k2")
    )
    joined = out.join(sums, ["c", "_chunk"]).withColumns({"k1": F.col("k1").bitwiseXOR(F.col("_k1")), "k2": F.col("k2").bitwiseXOR(F.col("_k2"))})
    return joined.drop("_chunk", "_k1", "_k2")


def _name(k1: Column, k2: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(k1), 16, "0"), F.lpad(F.hex(k2), 16, "0")))


ROOT = bytes(16)


def nodes_and_ends(turns: DataFrame, convs: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The nodes as (id, parent, depth, conv_id, n_convs, words) and the ends as (id, c)."""
    hashed = turns.withColumns({"e1": F.xxhash64("i", "a", "b"), "e2": F.xxhash64(F.lit(2), "b", "a", "i")}).drop("a", "b")
    keyed = _running(hashed, chunk)
    above = _name(F.col("k1").bitwiseXOR(F.col("e1")), F.col("k2").bitwiseXOR(F.col("e2")))
    keyed = settled(
        keyed.select(
            _name(F.col("k1"), F.col("k2")).alias("id"), F.when(F.col("i") == 0, F.lit(ROOT)).otherwise(above).alias("parent"),
            (F.col("i") + 1).alias("depth"), "c", "words", "last",
        ),
        "prefixes",
    )
    below = keyed.groupBy("id").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
    )
    root = convs.groupBy().agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("words"),
    )
    ends = keyed.filter("last").select("id", "c").unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("id"), "c"))
    return settled(below.unionByName(root), "nodes"), ends


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(id, leaves, saved) of ``nodes`` (id, parent, leaves, saved): sums over each node's subtree."""
    alive = nodes.select("id", "parent", *_SUMS, *[F.lit(0).cast("long").alias(f"x_{s}") for s in _SUMS])
    raked, chains = [], []
    while True:
        # x_ is what a node passes to its parent besides its own total: what was compressed between them
        kids = alive.filter("parent is not null").groupBy(F.col("parent").alias("_p")).agg(
            F.count(F.lit(1)).alias("kids"), F.min("id").alias("only"), *[F.max(f"x_{s}").alias(f"only_{s}") for s in _SUMS]
        )
        state = settled(alive.join(kids, F.col("id") == F.col("_p"), "left").drop("_p"), "state")
        if state.filter("kids is not null").isEmpty():
            raked.append(state.select("id", *_SUMS))
            break
        unary = F.coalesce((F.col("kids") == 1) & F.col("parent").isNotNull(), F.lit(False))
        chain = _chains(state.filter(unary))
        left = state.filter(~unary)
        if chain is not None:
            chains.append(chain)
            upper = chain.groupBy(F.col("next").alias("_id")).agg(F.max_by(F.struct("parent", *_SUMS, *[f"x_{s}" for s in _SUMS]), "hops").alias("_t"))
            left = left.join(upper, F.col("id") == F.col("_id"), "left").withColumns(
                {"parent": F.coalesce("_t.parent", "parent")}
                | {f"x_{s}": F.coalesce(F.col(f"_t.{s}") + F.col(f"_t.x_{s}"), f"x_{s}") for s in _SUMS}
            )
            left = settled(left.drop("_id", "_t"), "compressed")
        leaves = left.filter("kids is null")
        raked.append(leaves.select("id", *_SUMS))
        sums = leaves.groupBy(F.col("parent").alias("_p")).agg(*[F.sum(F.col(s) + F.col(f"x_{s}")).alias(f"_{s}") for s in _SUMS])
        inner = left.filter("kids is not null").join(sums, F.col("id") == F.col("_p"), "left")
        added = {s: F.col(s) + F.coalesce(F.col(f"_{s}"), F.lit(0)) for s in _SUMS}
        alive = settled(inner.withColumns(added).select("id", "parent", *_SUMS, *[f"x_{s}" for s in _SUMS]), "raked")
    totals = reduce(DataFrame.unionByName, raked)
    for chain in reversed(chains):
        ends = totals.select(F.col("id").alias("_id"), *[F.col(s).alias(f"_{s}") for s in _SUMS])
        known = chain.join(ends, F.col("next") == F.col("_id")).select("id", *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in _SUMS])
        totals = totals.unionByName(settled(known, "expanded"))
    return totals


def _chains(unary: DataFrame) -> DataFrame | None:
    """Nodes with one child, with ``next``, the node below the lower end of their chain, the number of ``hops`` to it and the
    sums from the node to there. None if there are none."""
    step = [(F.col(s) + F.col(f"only_{s}")).alias(s) for s in _SUMS]
    active = unary.select("id", F.col("only").alias("next"), F.lit(1).cast("long").alias("hops"), *step, "parent", *[f"x_{s}" for s in _SUMS])
    active, done = settled(active, "chain"), []
    if active.isEmpty():
        return None
    while True:
        known = reduce(DataFrame.unionByName, [*done, active])
        ahead = known.select(F.col("id").alias("_id"), F.col("next").alias("_next"), *[F.col(x).alias(f"_{x}") for x in ("hops", *_SUMS)])
        joined = active.join(ahead, F.col("next") == F.col("_id"), "left")
        further = {x: F.col(x) + F.coalesce(F.col(f"_{x}"), F.lit(0)) for x in ("hops", *_SUMS)}
        joined = joined.withColumns({"next": F.coalesce("_next", "next"), "moved": F.col("_id").isNotNull(), **further})
        joined = settled(joined.select(*active.columns, "moved"), "chain")
        done.append(joined.filter("not moved").drop("moved"))
        active = joined.filter("moved").drop("moved")
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the ascending ids that end at a node, joined by commas.

    Ids are sorted by range and joined to pieces where they lie, so a node at which very many end is spread over many
    tasks; only its pieces, tens of thousands of characters each, are hashed one after the other.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, words, size, n = None, [], 0, 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"id": [node], "part": [part], "n": [n], "joined": [",".join(words)]}, schema)

        schema = pa.schema([("id", pa.binary()), ("part", pa.int32()), ("n", pa.int64()), ("joined", pa.string())])
        done: list[pa.RecordBatch] = []
        for batch in batches:
            for i, c, p in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if words and (i != node or size > PIECE):
                    done.append(piece())
                    n, words, size = n + 1, [], 0
                node, part = i, p
                words.append(str(c))
                size += len(words[-1]) + 1
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if words:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            ids, found = [], []
            for i, joined in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if i != node:
                    if digest is not None:
                        ids.append(node)
                        found.append(digest.hexdigest())
                    node, digest = i, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(joined.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(found, pa.string())], names=["id", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["id", "ends_sha256"])

    ranged = ends.repartitionByRange("id", "c").sortWithinPartitions("id", "c").select("id", "c", F.spark_partition_id().alias("part"))
    cut = settled(ranged.mapInArrow(pieces, "id binary, part int, n long, joined string"), "pieces")
    return cut.repartition("id").sortWithinPartitions("id", "part", "n").mapInArrow(digests, "id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes with their members, children, totals of their subtrees and the digest of what ends there."""
    turns, convs = rebuilt_turns(conversations)
    nodes, ends = nodes_and_ends(turns, convs)
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("_id")).agg(F.count(F.lit(1)).alias("_kids"))
    counted = nodes.join(kids, F.col("id") == F.col("_id"), "left").withColumn("n_children", F.coalesce("_kids", F.lit(0).cast("long")))
    counted = settled(counted.drop("_id", "_kids"), "counted")
    own = counted.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = subtree_totals(own)
    named = counted.filter("n_children > 0").select(F.col("id").alias("_pid"), F.col("conv_id").alias("parent_conv_id"))
    # all first turns hang below the root: its id is a value, not a key to join on
    root = counted.filter("depth = 0").select("conv_id").first()
    first = counted.filter("depth = 1").withColumn("parent_conv_id", F.lit(root and root[0]).cast(counted.schema["conv_id"].dataType))
    rest = counted.filter("depth <> 1").join(named, F.col("parent") == F.col("_pid"), "left").drop("_pid")
    whole = first.unionByName(rest)
    whole = whole.join(totals, "id").join(end_digests(ends), "id", "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
