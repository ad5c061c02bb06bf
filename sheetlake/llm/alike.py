"""Groups of alike sketches, and exact links between sets, in array operations.

A label is the place of the first row known to be in the same group.  Rows that share a label are not compared
again, so a group of many rows that are all alike costs in proportion to its rows, not to its pairs.
"""

from __future__ import annotations

import numpy as np

from sheetlake.llm.shingles import SKETCH, jaccard_at_least

TILE = 256
#: Bytes of two sketches that are compared before most pairs are given up.
FIRST = 64
#: Units of up to so many rows are compared many at a time.
FEW = 64
PAIRS = 1 << 14
#: Sets that are compared with one other before labels are looked at again.
SOME = 64


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give rows that the pairs connect one label, the least."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        up = np.arange(len(label))
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up, further := up[up]):
            up = further
        label[:] = up[label]


def _agree(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Which of the pairs agree in at least so many bytes."""
    parts = [np.count_nonzero(left[a[k : k + PAIRS]] == right[b[k : k + PAIRS]], axis=1) for k in range(0, len(a), PAIRS)]
    return np.concatenate([np.zeros(0, np.int64), *parts]) >= least


def _tile(left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of two matrices that agree in at least so many bytes."""
    rows, columns = np.ascontiguousarray(left.T)[:, :, None], np.ascontiguousarray(right.T)[:, None, :]
    same = np.zeros((len(left), len(right)), np.uint8)
    equal = np.empty(same.shape, bool)
    for c in range(FIRST):
        np.equal(rows[c], columns[c], out=equal)
        np.add(same, equal.view(np.uint8), out=same)
    a, b = np.nonzero(same >= max(0, least - (SKETCH - FIRST)))
    if 16 * len(a) <= same.size:
        keep = _agree(left, right, a, b, least)
        return a[keep], b[keep]
    for c in range(FIRST, SKETCH):
        np.equal(rows[c], columns[c], out=equal)
        np.add(same, equal.view(np.uint8), out=same)
    return np.nonzero(same >= least)


def _one_unit(marks: np.ndarray, least: int) -> np.ndarray:
    """The labels of one unit, tile by tile; rows of one label are put side by side and their tiles left out."""
    label = np.arange(len(marks))
    order = label.copy()
    for i in range(0, len(marks), TILE):
        left = order[i : i + TILE]
        for j in range(i, len(marks), TILE):
            right = order[j : j + TILE]
            if (label[left] == label[left[0]]).all() and (label[right] == label[left[0]]).all():
                continue
            a, b = _tile(marks[left], marks[right], least)
            merge(label, left[a], right[b])
        rest = order[i + TILE :]
        order[i + TILE :] = rest[np.argsort(label[rest], kind="stable")]
    return label


def groups(marks: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """The labels of the rows of many units, which lie one after the other between bounds."""
    place = np.arange(len(marks))
    label = place.copy()
    sizes = np.diff(bounds)
    ends = np.repeat(np.where(sizes <= FEW, bounds[1:], 0), sizes)
    for step in range(1, FEW):
        a = place[place + step < ends]
        if not len(a):
            break
        a = a[label[a] != label[a + step]]
        a = a[_agree(marks, marks, a, a + step, least)]
        merge(label, a, a + step)
    for k in np.flatnonzero(sizes > FEW).tolist():
        first, last = bounds[k], bounds[k + 1]
        label[first:last] = first + _one_unit(marks[first:last], least)
    return label


def links(marks: np.ndarray, members: list[bytes], least: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sketches agree in so many bytes and 100 * |both| >= percent * |either|."""
    if len(members) < 4:
        sets = [np.frombuffer(x, np.uint64) for x in members]
        found, label = [], np.arange(len(sets))
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                alike = label[a] != label[b] and np.count_nonzero(marks[a] == marks[b]) >= least
                if alike and jaccard_at_least(sets[a], sets[b], percent):
                    found.append((a, b))
                    merge(label, np.array([a]), np.array([b]))
        return found
    sizes = np.array([len(x) // 8 for x in members])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    names = np.unique(np.frombuffer(b"".join(members), np.uint64), return_inverse=True)[1].astype(np.int32)
    inside = np.zeros(len(names) and names.max() + 1, bool)
    label = np.arange(len(members))
    found = []
    for i in range(len(members) - 1):
        rest = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
        rest = rest[_agree(marks, marks, np.full(len(rest), i), rest, least)]
        if not len(rest):
            continue
        own = names[starts[i] : ends[i]]
        inside[own] = True
        while len(rest):
            some, rest = rest[:SOME], rest[SOME:]
            size = sizes[some]
            upto = np.cumsum(size)
            place = np.repeat(starts[some] - (upto - size), size) + np.arange(upto[-1])
            both = np.diff(np.concatenate([[0], np.cumsum(inside[names[place]])[upto - 1]]))
            some = some[100 * both >= percent * (sizes[i] + size - both)]
            if len(some):
                some = some[np.unique(label[some], return_index=True)[1]]
                found += [(i, j) for j in some.tolist()]
                merge(label, np.full(len(some), i), some)
                rest = rest[label[rest] != label[i]]
        inside[own] = False
    return found
