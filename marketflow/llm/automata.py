"""Weighted acyclic automata: minimal transducers from sorted keys (sequences of labels) to counts.

`Builder` adds keys in order. States that no later key can change are merged with equal ones at once, so only the path
of the last key is open. A weight stands as far ahead as its keys allow (each arc carries the least of what follows),
so that equal tails of different weight are one state. The weight of a key is the sum along its path.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa

Key = tuple[bytes, ...]
# A transducer as columns, for counts of one shard (below 2^31). State s has the arcs first[s] to first[s + 1]; final is the weight at its end, -1 if no key
# ends there; the last state is the root.
COLUMNS = {
    "labels": pa.list_(pa.binary()), "first": pa.list_(pa.int32()), "label": pa.list_(pa.int32()), "target": pa.list_(pa.int32()),
    "weight": pa.list_(pa.int32()), "final": pa.list_(pa.int32()),
}
TYPES = "labels array<binary>, first array<int>, label array<int>, target array<int>, weight array<int>, final array<int>"


class Transducer:
    def __init__(self, labels: list[bytes], first: list[int], label: list[int], target: list[int], weight: list[int], final: list[int]):
        self.labels, self.first, self.label, self.target, self.weight, self.final = labels, first, label, target, weight, final

    def columns(self) -> tuple:
        return self.labels, self.first, self.label, self.target, self.weight, self.final

    def items(self) -> Iterator[tuple[Key, int]]:
        """Keys and weights in order."""
        stack = [(len(self.final) - 1, (), 0)]
        while stack:
            state, key, total = stack.pop()
            if self.final[state] >= 0:
                yield key, total + self.final[state]
            for arc in range(self.first[state + 1] - 1, self.first[state] - 1, -1):
                stack.append((self.target[arc], (*key, self.labels[self.label[arc]]), total + self.weight[arc]))

    def _arcs(self, state: int) -> dict[bytes, int]:
        return {self.labels[self.label[arc]]: arc for arc in range(self.first[state], self.first[state + 1])}

    def compose(self, other: Transducer) -> Iterator[tuple[Key, int]]:
        """The keys of this one that `other` has too, with the weights of `other`; both are walked side by side."""
        stack = [(len(self.final) - 1, len(other.final) - 1, (), 0)]
        while stack:
            mine, theirs, key, total = stack.pop()
            if self.final[mine] >= 0 and other.final[theirs] >= 0:
                yield key, total + other.final[theirs]
            few, many = self._arcs(mine), other._known(theirs)
            for label in sorted(few, reverse=True):
                if label in many:
                    arc = many[label]
                    stack.append((self.target[few[label]], other.target[arc], (*key, label), total + other.weight[arc]))

    def _known(self, state: int) -> dict[bytes, int]:
        """Arcs by label, kept, as a state may be met often."""
        if not hasattr(self, "_index"):
            self._index: dict[int, dict[bytes, int]] = {}
        if state not in self._index:
            self._index[state] = self._arcs(state)
        return self._index[state]


class Builder:
    def __init__(self) -> None:
        self.path: list[list] = [[None, []]]  # open states: weight at the end, arcs [label, weight, target]
        self.last: Key = ()
        self.known: dict[tuple, int] = {}
        self.names: dict[bytes, int] = {}
        self.out = Transducer([], [0], [], [], [], [])
        self.keys = 0

    def add(self, key: Key, weight: int) -> None:
        """`key` comes after all keys before it."""
        path, last = self.path, self.last
        common = 0
        for a, b in zip(key, last, strict=False):
            if a != b:
                break
            common += 1
        self._close(common)
        for i in range(common):
            arc, state = path[i][1][-1], path[i + 1]
            rest = arc[1] - weight
            if rest > 0:  # what exceeds moves behind the arc
                arc[1] = weight
                for later in state[1]:
                    later[1] += rest
                if state[0] is not None:
                    state[0] += rest
            weight -= arc[1]
        for label in key[common:]:
            path[-1][1].append([label, weight, None])
            path.append([None, []])
            weight = 0
        path[-1][0] = weight
        self.last = key
        self.keys += 1

    def _close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self._stored(self.path.pop())
            self.path[-1][1][-1][2] = state

    def _stored(self, state: list) -> int:
        final, arcs = state
        signature = (final, *map(tuple, arcs))
        number = self.known.get(signature)
        if number is None:
            out = self.out
            number = self.known[signature] = len(out.final)
            for label, weight, target in arcs:
                if label not in self.names:
                    self.names[label] = len(out.labels)
                    out.labels.append(label)
                out.label.append(self.names[label])
                out.weight.append(weight)
                out.target.append(target)
            out.first.append(len(out.label))
            out.final.append(-1 if final is None else final)
        return number

    def done(self) -> Transducer:
        self._close(0)
        self.known.clear()  # the root is a state of its own, the last
        self._stored(self.path[0])
        return self.out


def built(items: Iterable[tuple[Key, int]]) -> Transducer:
    builder = Builder()
    for key, weight in items:
        builder.add(key, weight)
    return builder.done()


def merged(several: Iterable[Iterator[tuple[Key, int]]]) -> Iterator[tuple[Key, int]]:
    """Keys of all in order, their weights added up."""
    for key, same in groupby(heapq.merge(*several), key=lambda x: x[0]):
        yield key, sum(w for _, w in same)


def union(several: list[Transducer]) -> Transducer:
    return built(merged(t.items() for t in several))


def from_row(batch: pa.RecordBatch, row: int) -> Transducer:
    return Transducer(*(batch.column(c)[row].as_py() for c in COLUMNS))


def columns_of(found: list[Transducer]) -> list[pa.Array]:
    """The transducers as Arrow columns."""
    out = []
    for i, kind in enumerate(COLUMNS.values()):
        parts = [t.columns()[i] for t in found]
        ends = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array([x for p in parts for x in p], kind.value_type)))
    return out
