"""Signature trees: self-joins of token sets by Jaccard similarity within one task."""

from __future__ import annotations

import numpy as np

from threadsift.llm.hashing import U64, mix

LEAF = 12
_ONE = U64(1)


def least_overlap(a: int, b: int, percent: int) -> int:
    """The least intersection of sets of a and b members with a similarity of at least percent / 100."""
    return -(-percent * (a + b) // (100 + percent))


class SignatureTree:
    """Sets in an order that keeps like ones together, under a binary hierarchy.

    A node is a run of that order; it has the OR of its sets' bitmaps, the range of their sizes, and the most tokens
    that a set has beyond its bits. Two sets share at most as many tokens as their bitmaps share bits, plus the lesser
    of their excesses; the same bound holds for all pairs under two nodes. ``label`` is the component of each set.
    """

    def __init__(self, names: np.ndarray, sizes: np.ndarray, tokens: list[np.ndarray], labels: np.ndarray | None = None, side: np.ndarray | None = None):
        widest = max((len(t) for t in tokens), default=1)
        self.bits = 1 << min(13, max(8, int(2 * widest - 1).bit_length()))
        maps = np.zeros((len(tokens), self.bits // 64), U64)
        for row, own in zip(maps, tokens, strict=True):
            at = mix(own) & U64(self.bits - 1)
            np.bitwise_or.at(row, (at >> U64(6)).astype(np.int64), _ONE << (at & U64(63)))
        least = np.array([int(mix(t).min()) if len(t) else 0 for t in tokens], np.uint64)
        order = np.lexsort((names, sizes, least, *(x for x in (labels, side) if x is not None)))
        self.names, self.sizes, self.maps = names[order], sizes[order].astype(np.int64), maps[order]
        self.tokens = [tokens[i] for i in order]
        self.label = np.arange(len(order)) if labels is None else labels[order]
        counts = np.array([len(t) for t in self.tokens], np.int64)
        self.excess = counts - np.bitwise_count(self.maps).sum(1).astype(np.int64)
        self._nodes: dict[tuple[int, int], tuple] = {}

    def node(self, a: int, b: int) -> tuple:
        """(OR of bitmaps, least size, greatest size, greatest excess) of the sets a to b."""
        found = self._nodes.get((a, b))
        if found is None:
            if b - a > LEAF:
                m = (a + b) // 2
                x, y = self.node(a, m), self.node(m, b)
                found = (x[0] | y[0], min(x[1], y[1]), max(x[2], y[2]), max(x[3], y[3]))
            else:
                sizes = self.sizes[a:b]
                found = (np.bitwise_or.reduce(self.maps[a:b], 0), int(sizes.min()), int(sizes.max()), int(self.excess[a:b].max()))
            self._nodes[(a, b)] = found
        return found

    def hopeless(self, x: tuple, y: tuple, percent: int) -> bool:
        if percent * max(x[1], y[1]) > 100 * min(x[2], y[2]) and (percent * y[1] > 100 * x[2] or percent * x[1] > 100 * y[2]):
            return True
        bound = int(np.bitwise_count(x[0] & y[0]).sum()) + min(x[3], y[3])
        return bound < least_overlap(x[1], y[1], percent)

    def join(self, percent: int, apart: int | None = None) -> list[tuple[int, int]]:
        """Links as pairs of positions, enough to connect what is connected. ``apart``: only pairs of which one set is
        before that position and the other at or behind it."""
        n, links = len(self.names), []
        if n < 2:
            return links
        todo = [((0, n), (0, n))] if apart is None else [((0, apart), (apart, n))]
        while todo:
            p, q = todo.pop()
            one, other = self.label[p[0] : p[1]], self.label[q[0] : q[1]]
            if one[0] == other[0] and (one == one[0]).all() and (other == one[0]).all():
                continue
            if p == q:
                if p[1] - p[0] > LEAF:
                    m = (p[0] + p[1]) // 2
                    todo += [((p[0], m), (m, p[1])), ((m, p[1]), (m, p[1])), ((p[0], m), (p[0], m))]
                else:
                    links += self._leaves(p, p, percent)
                continue
            if self.hopeless(self.node(*p), self.node(*q), percent):
                continue
            wide_p, wide_q = p[1] - p[0] > LEAF, q[1] - q[0] > LEAF
            if wide_p and (not wide_q or p[1] - p[0] >= q[1] - q[0]):
                m = (p[0] + p[1]) // 2
                todo += [((m, p[1]), q), ((p[0], m), q)]
            elif wide_q:
                m = (q[0] + q[1]) // 2
                todo += [(p, (m, q[1])), (p, (q[0], m))]
            else:
                links += self._leaves(p, q, percent)
        return links

    def _leaves(self, p: tuple[int, int], q: tuple[int, int], percent: int) -> list[tuple[int, int]]:
        a, b = np.arange(*p), np.arange(*q)
        shared = np.bitwise_count(self.maps[a][:, None, :] & self.maps[b][None, :, :]).sum(2).astype(np.int64)
        bound = shared + np.minimum(self.excess[a][:, None], self.excess[b][None, :])
        need = -(-percent * (self.sizes[a][:, None] + self.sizes[b][None, :]) // (100 + percent))
        links = []
        for i, j in zip(*np.nonzero(bound >= need), strict=True):
            x, y = int(a[i]), int(b[j])
            if x == y or (p == q and x > y) or self.label[x] == self.label[y]:
                continue
            own, other = self.tokens[x], self.tokens[y]
            if len(own) > len(other):
                own, other = other, own
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            if int((other[at] == own).sum()) >= need[i, j]:
                links.append((x, y))
                self.label[self.label == max(self.label[x], self.label[y])] = min(self.label[x], self.label[y])
        return links
