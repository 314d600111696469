"""Jaccard join of documents on word shingles, with signature trees.

The shingles of a text are its runs of five words (of fewer words, all as one). Documents with equal shingle sets are one
set, named by its hash; the join is between sets. It is exact and never looks at all pairs:

1. Sharing. A set can have a partner only if at most a quarter of its shingles are in no other set. That is tested on
   the shingles in one half of the hash space, by the exchange of ``exchange.py``: a set of which more than a quarter of
   all shingles are found alone in that half is done. A shingle in very many documents costs one entry per chunk.
2. Prefixes. Among the remaining sets the frequency of each shingle is counted the same way. Two sets that link share
   one of the rarest quarter of each other's shingles, so sets that meet there, directly or by others, form a field;
   links never cross fields.
3. Trees. A field's sets are joined in tasks by signature trees (``sets.py``). Small fields share tasks; a field beyond
   the size of a task is cut into tiles. Tiles are joined within themselves, then their components' first sets
   among each other until one tile holds them, and last every pair of tiles that is not one component already and that
   the roots of their trees do not rule out.

What is kept of a set of links is a forest that connects the same documents.

Hashes have 64 bits; the chance that two of n different sets or two shingles of one pair get the same is below
n**2 / 2**65. Words and A-Z are taken as in ``hashing.py``.

Defined results: a NULL text or one without words has no shingles and is linked with nothing, its component is itself;
repeated rows are linked as equal sets; rows with NULL doc_id count as members, but never name a component unless
all its rows are without; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadsift.llm.components import components
from threadsift.llm.exchange import MOST_BUCKETS, PACKED, SHARED, batch, canonical, find_shared, gathered, send, table_of
from threadsift.llm.hashing import U64, flat, groups, mix, shingle_hashes, word_hashes
from threadsift.llm.sets import SignatureTree
from threadsift.llm.tables import settled, small_side
from threadsift.llm.workers import release

SHINGLE_WORDS = 5
PERCENT = 75
#: Text that one chunk covers, shingles that one bucket task sorts, and bytes of sets that one tree task joins.
CHUNK_BYTES = 1 << 21
BUCKET_SHINGLES = 1_000_000
TILE_BYTES = 1 << 22

_DOC_SETS = "doc_id {key}, text_key long, n int, set_id long, need int"


def _unique_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, their number, and the name of each set (0 for none)."""
    sets = []
    for i, j in groups(offsets):
        words, at = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        hashes, at = shingle_hashes(words, at, k)
        sets += [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    n = np.array([len(s) for s in sets], np.int64)
    names = np.array([int(mix(s).sum(dtype=U64)) for s in sets], U64)
    names = np.where(n > 0, mix(names + n.astype(U64)) >> U64(1) | U64(1), U64(0))
    return np.concatenate(sets) if sets else np.zeros(0, U64), n, names


def _tested(tokens: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the shingles are in the tested half, and how many of those must be shared in each text."""
    half = tokens < U64(1 << 63)
    own = np.repeat(np.arange(len(n)), n)
    spare = n - -(-percent * n // 100)  # shingles that may be in no other set
    return half, np.maximum(0, np.bincount(own, half, len(n)).astype(np.int64) - spare)


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def document_sets(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n, set_id, need): a hash of the text, the number of distinct shingles, the set's name (NULL
    without shingles), and how many of its tested shingles must be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in batches:
            data, offsets = flat(part.column(2))
            for i, j in groups(offsets, CHUNK_BYTES):
                tokens, n, names = _unique_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                _, need = _tested(tokens, n, percent)
                ids = pa.array(names.astype(np.int64), pa.int64(), mask=n == 0)
                keys = [part.column(c).slice(i, j - i) for c in (0, 1)]
                columns = [*keys, pa.array(n, pa.int32()), ids, pa.array(need, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n", "set_id", "need"])

    return docs.select("doc_id", _text_key(docs).alias("text_key"), "text").mapInArrow(run, _DOC_SETS.format(key=docs.schema["doc_id"].dataType.simpleString()))


def _send_shingles(buckets: int, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[int] = set()  # a set that a task meets again needs no second entry
        for part in batches:
            data, offsets = flat(part.column(0))
            for i, j in groups(offsets, CHUNK_BYTES):
                tokens, n, names = _unique_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                half, need = _tested(tokens, n, percent)
                fresh = n > 0
                for at in np.flatnonzero(fresh).tolist():
                    name = int(names[at])
                    if name in seen:
                        fresh[at] = False
                    seen.add(name)
                own = np.repeat(np.arange(len(n)), n)
                sent = half & fresh[own]  # the upper bit of these is zero
                rows = send(canonical(tokens[sent] << U64(1), buckets), own[sent], names, need, buckets)
                yield from table_of(PACKED, rows).to_batches()
        del seen
        release()

    return run


_SETS = "set_id long, n int, tokens binary"


_NAMES = "set_id long"


def _enough_shared(key, part):
    """The sets of which as many of the tested shingles are shared as need be."""
    if SHARED not in part.column("kind").to_pylist():
        return table_of(_NAMES, [])
    name, need, _, starts, ends = gathered(part)
    found = name[starts[ends - starts >= need[starts]]].astype(np.int64).tolist()
    del name, need, starts, ends
    release()
    return table_of(_NAMES, [(v,) for v in found])


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            data, offsets = flat(part.column(0))
            for i, j in groups(offsets, CHUNK_BYTES):
                tokens, n, names = _unique_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                cuts = np.concatenate(([0], np.cumsum(n)))
                rows = [(int(names[x]), int(n[x]), tokens[cuts[x] : cuts[x + 1]].tobytes()) for x in np.flatnonzero(n).tolist()]
                yield from table_of(_SETS, rows).to_batches()

    return run


def possible_sets(docs: DataFrame, owners: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(set_id, n, tokens): the sets that can have a partner, with their shingles. ``owners`` are the document_sets."""
    shingles = owners.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = min(MOST_BUCKETS, max(1, -(-int(shingles) // 2 // BUCKET_SHINGLES)))
    sent = docs.select("text").mapInArrow(_send_shingles(buckets, k, percent), PACKED)
    shared = sent.groupBy("bucket").applyInArrow(find_shared(buckets), PACKED)
    names = shared.groupBy("bucket").applyInArrow(_enough_shared, _NAMES)
    names = settled(names.unionByName(owners.filter("need = 0 and set_id is not null").select("set_id")).distinct(), "possible")
    known = owners.join(small_side(names.withColumnRenamed("set_id", "_set")), F.col("set_id") == F.col("_set"))
    firsts = settled(known.groupBy("set_id").agg(F.min("doc_id").alias("_id")).select("_id").distinct(), "firsts")
    texts = docs.select("doc_id", "text").join(small_side(firsts), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return texts.select("text").mapInArrow(_whole_sets(k), _SETS)


def _set_arrays(part: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    tokens = [np.frombuffer(t, "<u8") for t in part.column("tokens").to_pylist()]
    return part.column("set_id").to_numpy(), part.column("n").to_numpy(), tokens


_COUNTS = "bucket int, chunk int, payload binary"
_PREFIX = "token long, set_id long"


def _send_counts(buckets: int):
    """For each chunk of sets, its distinct shingles and how many sets have them, to the buckets of the shingles."""

    def run(key, part):
        values, counts = np.unique(np.concatenate(_set_arrays(part)[2]), return_counts=True)
        to = (mix(values) % U64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        chunk, rows = key[0].as_py(), []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            at = order[cuts[b] : cuts[b + 1]]
            rows.append((b, chunk, values[at].astype("<u8").tobytes() + counts[at].astype("<u8").tobytes()))
        del values, counts, to, order
        release()
        return table_of(_COUNTS, rows)

    return run


def _add_counts(key, part):
    """The counts over all chunks, back to each chunk, where above one."""
    pairs = [np.frombuffer(p, "<u8").reshape(2, -1) for p in part.column("payload").to_pylist()]
    values = np.concatenate([p[0] for p in pairs])
    names, place = np.unique(values, return_inverse=True)
    totals = np.bincount(place, np.concatenate([p[1] for p in pairs]).astype(np.float64)).astype(np.uint64)
    rows, a = [], 0
    for chunk, (own, _) in zip(part.column("chunk").to_pylist(), pairs, strict=True):
        total = totals[place[a : a + len(own)]]
        a += len(own)
        some = total > 1
        if some.any():
            rows.append((key[0].as_py(), chunk, own[some].astype("<u8").tobytes() + total[some].astype("<u8").tobytes()))
    del pairs, values, names, place, totals
    release()
    return table_of(_COUNTS, rows)


def _prefixes(percent: int):
    """The shingles in which a set meets its possible partners: of the rarest that it may miss and one more, those
    that others have too."""

    def run(key, part, counted):
        out_tokens, out_sets = [], []
        if part.num_rows and counted.num_rows:
            pairs = [np.frombuffer(p, "<u8").reshape(2, -1) for p in counted.column("payload").to_pylist()]
            values, totals = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            order = np.argsort(values)
            values, totals = values[order], totals[order]
            for sid, n, own in zip(*_set_arrays(part), strict=True):
                at = np.minimum(np.searchsorted(values, own), len(values) - 1)
                often = np.where(values[at] == own, totals[at], 1)
                length = int(n) - -(-percent * int(n) // 100) + 1 - (int(n) - len(own))
                rarest = np.lexsort((own, often))[: max(0, length)]
                chosen = own[rarest[often[rarest] > 1]]
                out_tokens.append(chosen.astype(np.int64))
                out_sets.append(np.full(len(chosen), sid, np.int64))
            del pairs, values, totals, order
            release()
        none = [np.zeros(0, np.int64)]
        return pa.Table.from_batches([batch(_PREFIX, np.concatenate(out_tokens or none), np.concatenate(out_sets or none))])

    return run


def prefixes(sets: DataFrame, shingles: int, percent: int = PERCENT) -> DataFrame:
    """(token, set_id): where sets meet."""
    parts = max(1, -(-shingles // BUCKET_SHINGLES))
    chunked = sets.withColumn("chunk", F.pmod("set_id", F.lit(parts)).cast("int"))
    counts = chunked.groupBy("chunk").applyInArrow(_send_counts(parts), _COUNTS)
    counts = counts.groupBy("bucket").applyInArrow(_add_counts, _COUNTS)
    return chunked.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_prefixes(percent), _PREFIX)


_EDGES = "a long, b long"


def _join_units(percent: int):
    """Each field (or tile of one) of a unit by its own tree; a set and the first set of its component."""

    def run(key, part):
        sids, sizes, tokens = _set_arrays(part)
        field = part.column("field").to_numpy()
        order = np.argsort(field, kind="stable")
        cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], np.diff(field[order]) != 0))), [len(order)]))
        out_a, out_b = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[a:b]
            tree = SignatureTree(sids[own], sizes[own], [tokens[i] for i in own])
            tree.join(percent)
            for label in np.unique(tree.label):
                members = tree.names[tree.label == label]
                out_a.append(members)
                out_b.append(np.full(len(members), members.min()))
            del tree
        release()
        return pa.Table.from_batches([batch(_EDGES, np.concatenate(out_a), np.concatenate(out_b))])

    return run


def _tiled(members: DataFrame, tile_bytes: int) -> DataFrame:
    """(set_id, field, bytes, tile, tiles) for (set_id, field, bytes): consecutive members up to the bytes of a tile."""
    order = Window.partitionBy("field").orderBy("n", "set_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tile = F.floor((F.sum("bytes").over(order) - F.col("bytes")) / tile_bytes)
    sizes = members.groupBy("field").agg(F.sum("bytes").alias("_all"), F.count(F.lit(1)).alias("_n")).withColumnRenamed("field", "_field")
    joined = members.join(sizes.filter("_n > 1"), F.col("field") == F.col("_field"))
    return joined.select("set_id", "n", "field", "bytes", F.col("_all").alias("field_bytes"), tile.alias("tile"))


def _star_edges(sets: DataFrame, tiled: DataFrame, tile_bytes: int, percent: int) -> DataFrame:
    total = tiled.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    units = max(1, -(-int(total) // tile_bytes))
    # small fields are dealt to units by hash; a tile of a large field is a unit of its own
    unit = F.when(F.col("field_bytes") <= tile_bytes, F.pmod(F.xxhash64("field"), F.lit(units))).otherwise(F.xxhash64("field", "tile"))
    places = tiled.select(F.col("set_id").alias("_id"), "field", unit.alias("unit"))
    return sets.join(places, F.col("set_id") == F.col("_id")).select("unit", "field", "set_id", "n", "tokens").groupBy("unit").applyInArrow(_join_units(percent), _EDGES)


_PAIR_EDGES = "a long, b long"


def _roots(percent: int):
    """Per tile: the root of its tree and the range of its components."""
    schema = "field long, tile long, map binary, least int, most int, excess int, first long, last long"

    def run(key, part):
        sids, sizes, tokens = _set_arrays(part)
        wide = np.zeros(512, U64)
        excess = 0
        for t in tokens:
            bits = np.unique(mix(t) & U64(32767)).astype(np.int64)
            np.bitwise_or.at(wide, bits >> 6, U64(1) << (bits & 63).astype(U64))
            excess = max(excess, len(t) - len(bits))
        root = part.column("root").to_numpy()
        row = (key[0].as_py(), key[1].as_py(), wide.tobytes(), int(sizes.min()), int(sizes.max()), excess, int(root.min()), int(root.max()))
        return pa.Table.from_batches([batch(schema, *([v] for v in row))])

    return run, schema


def _join_tiles(percent: int):
    def run(key, part):
        sids, sizes, tokens = _set_arrays(part)
        side, root = part.column("side").to_numpy(), part.column("root").to_numpy()
        labels = np.unique(root, return_inverse=True)[1]
        tree = SignatureTree(sids, sizes, tokens, labels, side)
        links = tree.join(percent, int((side == 0).sum()))
        return pa.Table.from_batches([batch(_PAIR_EDGES, [int(tree.names[x]) for x, _ in links], [int(tree.names[y]) for _, y in links])])

    return run


def _plausible(percent: int):
    """Keeps pairs of tiles whose roots allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            keep = []
            for i in range(batch.num_rows):
                if c["first"][i] == c["last"][i] == c["first2"][i] == c["last2"][i]:
                    continue
                if percent * c["least2"][i] > 100 * c["most"][i] or percent * c["least"][i] > 100 * c["most2"][i]:
                    continue
                both = np.frombuffer(c["map"][i], "<u8") & np.frombuffer(c["map2"][i], "<u8")
                bound = int(np.bitwise_count(both).sum()) + min(c["excess"][i], c["excess2"][i])
                if bound >= -(-percent * (c["least"][i] + c["least2"][i]) // (100 + percent)):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select(["field", "tile", "tile2"])

    return run


def link_components(sets: DataFrame, meetings: DataFrame, percent: int = PERCENT, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(node, root): sets by the component of their links."""
    heads = meetings.groupBy("token").agg(F.min("set_id").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    edges = meetings.join(heads.select(F.col("token").alias("_t"), "b"), F.col("token") == F.col("_t")).filter("set_id <> b")
    fields = components(edges.select(F.col("set_id").alias("a"), "b").distinct()).toDF("node", "field")
    narrow = sets.select("set_id", "n", F.octet_length("tokens").cast("long").alias("bytes"))
    members = narrow.join(fields, F.col("set_id") == F.col("node")).select("set_id", "n", "bytes", "field")
    first = settled(_tiled(members, tile_bytes), "tiles")
    found = settled(_star_edges(sets, first, tile_bytes, percent), "links")
    large = first.filter(F.col("field_bytes") > tile_bytes)
    tiles = large.select("field", "tile").distinct().count()
    if not tiles:
        return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # components of tiles by their first sets, until one tile holds those of a field or they do not get fewer
    edges, left, before = found, found, None
    while before is None or tiles < before:
        heads = left.select(F.col("b").alias("_b")).distinct()
        members = large.join(heads, F.col("set_id") == F.col("_b")).select("set_id", "n", "bytes", "field")
        again = settled(_tiled(members, tile_bytes), "tiles")
        left = settled(_star_edges(sets, again, tile_bytes, percent), "links")
        edges = edges.unionByName(left)
        before, tiles = tiles, again.filter(F.col("field_bytes") > tile_bytes).select("field", "tile").distinct().count()
        if not tiles:
            break
    labels = components(edges).toDF("_node", "root")
    places = large.join(labels, F.col("set_id") == F.col("_node"), "left")
    places = settled(places.select(F.col("set_id").alias("_id"), "field", "tile", F.coalesce("root", "set_id").alias("root")), "places")
    placed = sets.join(places, F.col("set_id") == F.col("_id")).select("set_id", "n", "tokens", "field", "tile", "root")
    run, schema = _roots(percent)
    roots = settled(placed.groupBy("field", "tile").applyInArrow(run, schema), "roots")
    others = roots.select(F.col("field").alias("_f"), *(F.col(c).alias(f"{c}2") for c in roots.columns[1:]))
    pairs = roots.join(others, (F.col("field") == F.col("_f")) & (F.col("tile") < F.col("tile2"))).drop("_f")
    pairs = settled(pairs.mapInArrow(_plausible(percent), "field long, tile long, tile2 long"), "pairs")
    sides = pairs.select("field", "tile", "tile2", F.lit(0).alias("side"), F.col("tile").alias("own")).unionByName(
        pairs.select("field", "tile", "tile2", F.lit(1).alias("side"), F.col("tile2").alias("own"))
    )
    sides = sides.toDF("_f", "tile1", "tile2", "side", "own")
    dealt = placed.join(sides, (F.col("field") == F.col("_f")) & (F.col("tile") == F.col("own")))
    dealt = dealt.select("field", "tile1", "tile2", "side", "set_id", "n", "tokens", "root")
    across = settled(dealt.groupBy("field", "tile1", "tile2").applyInArrow(_join_tiles(percent), _PAIR_EDGES), "across")
    return components(edges.unionByName(across))


def _rooted(docs: DataFrame, percent: int, k: int, tile_bytes: int) -> DataFrame:
    """(doc_id, text_key, n, set_id, _root) for every row: rows that links connect have the same root (NULL without
    shingles)."""
    owners = settled(document_sets(docs, k, percent), "owners")
    sets = settled(possible_sets(docs, owners, k, percent), "sets")
    rows = sets.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("set_id").alias("d")).first()
    if rows["n"] != rows["d"]:  # several rows with the smallest doc_id of a set, or without doc_id
        sets = settled(sets.dropDuplicates(["set_id"]), "sets")
    shared = sets.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0] // 8
    meetings = settled(prefixes(sets, shared, percent), "meetings")
    roots = settled(link_components(sets, meetings, percent, tile_bytes), "roots").toDF("_node", "_root")
    known = owners.join(roots, F.col("set_id") == F.col("_node"), "left")
    return known.select("doc_id", "text_key", "n", "set_id", F.coalesce("_root", "set_id").alias("_root"))


def near_components(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_id, component_id) for every row: component_id is the least doc_id reachable by
    links."""
    known = _rooted(docs, percent, k, tile_bytes)
    least = known.filter("_root is not null").groupBy("_root").agg(F.min("doc_id").alias("_least")).withColumnRenamed("_root", "_own")
    named = known.join(least, F.col("_root") == F.col("_own"), "left")
    component = F.when(F.col("_root").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return named.select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), "set_id", component.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked ones: that of the smallest doc_id, rows without doc_id last,
    then of the smallest hash of the text. Of repeated rows one stays; rows without shingles stay."""
    known = _rooted(docs, percent, SHINGLE_WORDS, TILE_BYTES)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = known.filter("_root is not null").groupBy("_root").agg(F.min(place).alias("_first")).withColumnRenamed("_root", "_own")
    found = known.join(first, F.col("_root") == F.col("_own"), "left")
    found = settled(found.select("doc_id", "text_key", place.eqNullSafe(F.col("_first")).alias("stays"), F.col("_root").isNotNull().alias("linked")), "components")
    gone = found.filter("linked and not stays").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (_text_key(docs) == F.col("_key"))
    left = docs.join(small_side(settled(gone, "gone")), same, "left_anti")
    stays = found.filter("linked and stays")
    repeated = settled(stays.groupBy("doc_id", "text_key").count().filter("count > 1").drop("count"), "repeated")
    if repeated.isEmpty():
        return left
    repeated = repeated.toDF("_id", "_key")
    once = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(once)
