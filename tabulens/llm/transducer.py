"""Weighted acyclic automata over sequences of labels, in layers, as numpy arrays.

A state of layer d is the end of a path of d labels; it has a weight. States are built from sorted paths: a path opens new states from the
first label on in which it differs from the path before it. Paths of unequal length are padded with -1 at their ends, so a path comes
before its extensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

#: States whose paths are made at a time.
PIECE_STATES = 250_000


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: byte planes (the upper ones are nearly constant), compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


class Transducer:
    """Layers of (labels, parents, weights); parents are positions in the layer before (all 0, the root, in the first)."""

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.layers = layers

    @classmethod
    def from_sorted(cls, paths: np.ndarray, weights: np.ndarray, prefixes: int | None = None) -> Transducer:
        """From paths (rows, sorted, may repeat). The weights of equal paths are summed.

        With `prefixes`, a state of that layer or a later one also counts the paths that go on from it.
        """
        n, depth = paths.shape
        layers, fresh, above = [], np.zeros(n, bool), np.zeros(n, np.int64)
        fresh[:1] = True
        for d in range(depth):
            here = paths[:, d]
            fresh = fresh.copy()
            fresh[1:] |= here[1:] != here[:-1]
            present = here >= 0
            opens = fresh & present
            state = np.cumsum(opens) - 1
            ends = present & ((paths[:, d + 1] < 0) if d + 1 < depth else True)
            counted = present if prefixes is not None and d + 1 >= prefixes else ends
            total = np.zeros(int(opens.sum()), np.int64)
            np.add.at(total, state[counted], weights[counted])
            layers.append((here[opens], above[opens], total))
            above = state
        return cls(layers)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All states with a weight as padded paths, sorted, and their weights."""
        depth = len(self.layers)
        # below[d]: states with a weight in the part under each state of layer d, itself too
        own, below = [weight != 0 for _, _, weight in self.layers], []
        for d in reversed(range(depth)):
            sums = own[d].astype(np.int64)
            if below:
                np.add.at(sums, self.layers[d + 1][1], below[-1])
            below.append(sums)
        below.reverse()
        rows = int(below[0].sum()) if below else 0
        found, weights = np.full((rows, depth), -1, np.int64), np.zeros(rows, np.int64)
        place, held = np.zeros(1, np.int64), np.zeros(1, bool)
        for d, (labels, parents, weight) in enumerate(self.layers):
            # a path comes behind the one it extends and behind what its earlier siblings lead to
            ahead = np.cumsum(below[d]) - below[d]
            place, held = (place + held)[parents] + ahead - ahead[np.searchsorted(parents, parents)], own[d]
            weights[place[held]] = weight[held]
            under = np.arange(int(below[d].sum()))
            under += np.repeat(place - ahead, below[d])
            found[under, d] = np.repeat(labels, below[d])
        return found, weights

    def compose(self, queries: np.ndarray) -> np.ndarray:
        """The weight of each padded query path, 0 where the automaton has no such path: all queries go down a layer at a time."""
        state, weight, alive = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64), np.ones(len(queries), bool)
        for d in range(queries.shape[1]):
            label = queries[:, d]
            alive = alive & (label >= 0)
            if not alive.any():
                break
            weight[alive] = 0
            if d >= len(self.layers):
                break
            labels, parents, weights = self.layers[d]
            # arcs of a layer are sorted by parent and label: number both in one key
            names, code = np.unique(labels, return_inverse=True)
            key = parents * len(names) + code
            at = np.searchsorted(names, label).clip(0, max(len(names) - 1, 0))
            known = alive & (names[at] == label) if len(names) else np.zeros(len(queries), bool)
            want = state * len(names) + at
            slot = np.searchsorted(key, want).clip(0, max(len(key) - 1, 0))
            alive = known & (key[slot] == want) if len(key) else known
            state = np.where(alive, slot, 0)
            weight[alive] = weights[slot[alive]]
        return weight

    def to_bytes(self) -> list[bytes]:
        """Per layer: labels, number of arcs of each state of the layer before, weights."""
        out, before = [], 1
        for labels, parents, weights in self.layers:
            out += [packed(labels), packed(np.bincount(parents, minlength=before)), packed(weights)]
            before = len(labels)
        return out

    @classmethod
    def of_bytes(cls, parts: list[bytes]) -> Transducer:
        layers = []
        for labels, arcs, weights in zip(parts[::3], parts[1::3], parts[2::3]):
            counts = unpacked(arcs)
            layers.append((unpacked(labels), np.repeat(np.arange(len(counts)), counts), unpacked(weights)))
        return cls(layers)

    def pieces(self, states: int = PIECE_STATES) -> Iterator[Transducer]:
        """The same paths in order, in parts of about so many states, cut between first labels; their arrays are views."""
        if not self.layers:
            return
        bounds = [np.arange(len(self.layers[0][0]) + 1)]  # per layer where the part under each state of the first begins
        for _, parents, _ in self.layers[1:]:
            bounds.append(np.searchsorted(parents, bounds[-1]))
        held, begin = sum(bounds), 0
        while begin < len(held) - 1:
            end = max(begin + 1, int(np.searchsorted(held, held[begin] + states, "right")) - 1)
            layers, above = [], 0
            for (labels, parents, weights), bound in zip(self.layers, bounds):
                here = slice(bound[begin], bound[end])
                layers.append((labels[here], parents[here] - above, weights[here]))
                above = bound[begin]
            yield Transducer(layers)
            begin = end

    def cut(self, edges: np.ndarray) -> list[tuple[int, Transducer]]:
        return list(self.cuts(edges))

    def cuts(self, edges: np.ndarray) -> Iterator[tuple[int, Transducer]]:
        """(range, part): the states of each range; edges are sorted paths or prefixes, a path lies behind those not above it, so equal paths do too.

        A range may come in several parts, without common paths.
        """
        for piece in self.pieces():
            paths, weights = piece.paths()
            where = ranges_of(paths, edges)
            starts = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else []
            for a, b in zip(starts, [*starts[1:], len(where)]):
                yield int(where[a]), Transducer.from_sorted(paths[a:b], weights[a:b])


def union(automata: list[Transducer]) -> Transducer:
    """One automaton with the paths of all, weights summed."""
    found = [a.paths() for a in automata]
    return Transducer.from_sorted(*sort_paths(np.concatenate([p for p, _ in found]), np.concatenate([w for _, w in found])))


def sort_paths(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(paths.T[::-1])
    return paths[order], weights[order]


def ranges_of(paths: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many of the sorted edges (of equal length, padded too) are not above each of the sorted paths."""
    low, high = np.zeros(len(edges), np.int64), np.full(len(edges), len(paths), np.int64)
    every = np.arange(len(edges))
    while (low < high).any():  # the first path that is not below each edge
        middle = (low + high) // 2
        here = paths[np.minimum(middle, len(paths) - 1), : edges.shape[1]]
        at = (here != edges).argmax(axis=1)
        below = (low < high) & (here[every, at] < edges[every, at])
        high = np.where(below, high, np.minimum(middle, high))
        low = np.where(below, middle + 1, low)
    return np.repeat(np.arange(len(edges) + 1), np.diff([0, *low, len(paths)]))
