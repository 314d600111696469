"""Finding values that several owners have, with one entry per chunk and value.

Owners (documents, sets of shingles) have many hashed values each. A chunk of owners sends every distinct value once to
the bucket of the value: with its owner if it has one in the chunk, without if it has several, for then the chunk
itself knows it to be shared. The bucket finds the values of several owners and sends them to the buckets of the
owners. So a value that very many owners have costs a bucket one entry per chunk. Rows are packed arrays.

A value is its bucket (below 2**15) and 48 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from threadsift.llm.hashing import U64
from threadsift.llm.workers import release

PACKED = "bucket int, kind int, payload binary"
#: Kinds of rows: values for their bucket, shared values for the buckets of their owners, crowded values with their
#: weights, values that weigh more than one in a chunk.
VALUES, SHARED, CROWDED, WEIGHTS = 0, 1, 2, 3
MOST_BUCKETS = 1 << 15


def batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def table_of(schema: str, rows: list[tuple]) -> pa.Table:
    columns = list(map(list, zip(*rows, strict=True))) or [[] for _ in schema.split(", ")]
    return pa.Table.from_batches([batch(schema, *columns)])


def pack(sids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, tokens: np.ndarray) -> bytes:
    head = np.array([len(sids), len(tokens)], "<u8")
    return head.tobytes() + sids.astype("<u8").tobytes() + sizes.astype("<u4").tobytes() + counts.astype("<u4").tobytes() + tokens.astype("<u8").tobytes()


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    runs, n = np.frombuffer(payload, "<u8", 2).tolist()
    sids = np.frombuffer(payload, "<u8", runs, 16)
    sizes = np.frombuffer(payload, "<u4", runs, 16 + 8 * runs)
    counts = np.frombuffer(payload, "<u4", runs, 16 + 12 * runs)
    return sids, sizes, counts, np.frombuffer(payload, "<u8", n, 16 + 16 * runs)


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the upper 24 bits of 64."""
    return (((tokens >> U64(40)) * U64(buckets)) >> U64(24)).astype(np.int64)


def _low(tokens: np.ndarray) -> np.ndarray:
    """The lower 48 bits as bytes."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def canonical(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The value of each hash: its bucket and its lower 48 bits."""
    return bucket_of(hashes, buckets).astype(U64) << U64(48) | hashes & U64((1 << 48) - 1)


def send(values: np.ndarray, own: np.ndarray, names: np.ndarray, sizes: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """The rows of a chunk: ``own`` says whose each (canonical) value is, an index of the owners' names (not 0) and
    sizes. No owner has a value twice."""
    order = np.argsort(values, kind="stable")
    values, own = values[order], own[order]
    first = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    several = ~first
    several[:-1] |= ~first[1:]
    at = (values >> U64(48)).astype(np.int64)
    single, multi = ~several, several & first
    cuts, multi_cuts = (np.searchsorted(at[which], np.arange(buckets + 1)) for which in (single, multi))
    s_values, s_own, m_values = values[single], own[single], values[multi]
    rows: list[tuple[int, int, bytes]] = []
    for b in range(buckets):
        x, y = slice(*cuts[b : b + 2]), slice(*multi_cuts[b : b + 2])
        if x.start == x.stop and y.start == y.stop:
            continue
        by_owner = np.argsort(s_own[x], kind="stable")
        owners, counts = np.unique(s_own[x], return_counts=True)
        some = pack(names[owners], sizes[owners], counts, np.zeros(0, U64))
        low = _low(s_values[x][by_owner]).tobytes() + _low(m_values[y]).tobytes()
        rows.append((b, VALUES, np.array([len(some), len(by_owner)], "<u8").tobytes() + some + low))
    o = own[several]
    return rows + to_owners(values[several], names[o], sizes[o], buckets)


def send_weights(values: np.ndarray, weights: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """What values of a chunk weigh, for their buckets; a value that is not named weighs one."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    cuts = np.searchsorted((values >> U64(48)).astype(np.int64), np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        x = slice(*cuts[b : b + 2])
        rows.append((b, WEIGHTS, values[x].astype("<u8").tobytes() + weights[x].astype("<u4").tobytes()))
    return rows


def to_owners(tokens: np.ndarray, sids: np.ndarray, sizes: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Shared values, packed for the buckets of their owners."""
    if not len(tokens):
        return []
    to = (sids % U64(buckets)).astype(np.int64)
    order = np.lexsort((tokens, sids, to))
    tokens, sids, sizes, to = tokens[order], sids[order], sizes[order], to[order]
    rows = []
    cuts = np.searchsorted(to, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        x = slice(*cuts[b : b + 2])
        names, first, counts = np.unique(sids[x], return_index=True, return_counts=True)
        rows.append((b, SHARED, pack(names, sizes[x][first], counts, tokens[x])))
    return rows


def find_shared(buckets: int, crowd: int | None = None):
    """For each bucket of values those of several owners, to the buckets of the owners; also the values that weigh more
    than ``crowd`` in all chunks together, and their weights."""

    def run(key, part):
        bucket = key[0].as_py()
        rows, values, sets, sizes = [], [], [], []
        heavy, weights = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for kind, payload in zip(part.column("kind").to_pylist(), part.column("payload").to_pylist(), strict=True):
            if kind == WEIGHTS:
                n = len(payload) // 12
                heavy.append(np.frombuffer(payload, "<u8", n) & U64((1 << 48) - 1))
                weights.append(np.frombuffer(payload, "<u4", n, 8 * n).astype(np.int64))
                continue
            if kind != VALUES:
                rows.append((bucket, kind, payload))
                continue
            length, n = np.frombuffer(payload, "<u8", 2).tolist()
            names, own, counts, _ = unpack(payload[16 : 16 + length])
            low = np.frombuffer(payload, np.uint8, offset=16 + length).reshape(-1, 6)
            wide = np.zeros((len(low), 8), np.uint8)
            wide[:, :6] = low
            values.append(wide.view("<u8")[:, 0])
            none = np.zeros(len(low) - n, U64)
            sets.append(np.concatenate((np.repeat(names, counts), none)))
            sizes.append(np.concatenate((np.repeat(own, counts), none.astype("<u4"))))
        if values:
            value, name, size = np.concatenate(values), np.concatenate(sets), np.concatenate(sizes)
            del values, sets, sizes, part
            order = np.argsort(value, kind="stable")
            value, name, size = value[order], name[order], size[order]
            starts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            entries = np.diff(np.concatenate((starts, [len(value)])))
            # several owners: an entry of a chunk that has several (name 0), or different names
            mixed = (np.minimum.reduceat(name, starts) != np.maximum.reduceat(name, starts)) | (name[starts] == 0)
            keep = np.repeat(mixed, entries) & (name != 0)
            upper = U64(bucket) << U64(48)
            rows += to_owners(value[keep] | upper, name[keep], size[keep], buckets)
            weight = entries.copy()
            np.add.at(weight, np.searchsorted(value[starts], np.concatenate(heavy)), np.concatenate(weights) - 1)
            if crowd is not None and (weight > crowd).any():
                many = weight > crowd
                crowded = np.stack((value[starts[many]] | upper, weight[many].astype(U64)))
                rows.append((bucket, CROWDED, crowded.astype("<u8").tobytes()))
            del value, name, size, order, starts, entries, mixed, keep
            release()
        return table_of(PACKED, rows)

    return run


def gathered(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the shared values of a bucket of owners: names, sizes, values in order, each once, and where each owner's
    begin and end."""
    names, sizes, values = [], [], []
    for payload in part.column("payload").to_pylist():
        s, n, counts, v = unpack(payload)
        names.append(np.repeat(s, counts))
        sizes.append(np.repeat(n, counts))
        values.append(v)
    name, size, value = np.concatenate(names), np.concatenate(sizes), np.concatenate(values)
    order = np.lexsort((value, name))
    name, size, value = name[order], size[order], value[order]
    fresh = np.concatenate(([True], (name[1:] != name[:-1]) | (value[1:] != value[:-1])))
    name, size, value = name[fresh], size[fresh], value[fresh]
    starts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    return name, size, value, starts, np.concatenate((starts[1:], [len(name)]))
