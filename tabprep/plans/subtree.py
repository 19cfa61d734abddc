"""An exact information-gain tree over the rows of one node, in one task's memory.

Every feature has a presorted attribute list: its rows in the order of their values, made once.
A split cuts each list in two and keeps the order, so no level sorts again. Candidates are
scanned along the lists: class counts left of a place are running sums.
"""

from __future__ import annotations

import numpy as np

from tabprep.operators.splits import GAIN_PLACES

#: Numbers of running counts held at once.
_COUNTS = 1 << 21
#: Counts up to which those of all classes are run up in one call.
_FEW = 1 << 16


def grow(x: np.ndarray, y: np.ndarray, node: int, depth: int, most: int, times: np.ndarray | None = None) -> list[tuple]:
    """``(node_id, depth, feature_no, threshold, label, n)`` of the node and all below it.

    ``x`` is features x rows with nan for missing values, ``y`` holds the labels; a row counts ``times``, or once.
    Rules are those of ``id3_fit``.
    """
    classes, codes = np.unique(y, return_inverse=True)
    # nan sorts last; the valid part of a list ends before it
    lists = [np.argsort(v, kind="stable")[: len(v) - int(np.isnan(v).sum())] for v in x]
    out: list[tuple] = []
    todo = [(node, depth, np.arange(len(y)), lists)]
    side = np.zeros(len(y), bool)
    while todo:
        node, depth, rows, lists = todo.pop()
        counts = np.bincount(codes[rows], weights=None if times is None else times[rows], minlength=len(classes)).astype(np.int64)
        label, n = classes[counts.argmax()].item(), int(counts.sum())
        best = None
        if depth < most and counts.max() < n:
            best = _best(x, codes, times, lists, counts > 0)
        if best is None:
            out.append((node, depth, None, None, label, n))
            continue
        feature, threshold = best
        out.append((node, depth, feature, threshold, label, n))
        side[rows] = ~(x[feature][rows] <= threshold)  # a missing value goes right
        for child, own in ((2 * node, ~side), (2 * node + 1, side)):
            kept = rows[own[rows]]
            if len(kept):
                todo.append((child, depth + 1, kept, [a[own[a]] for a in lists]))
    return out


def _best(x: np.ndarray, codes: np.ndarray, times: np.ndarray | None, lists: list[np.ndarray], present: np.ndarray) -> tuple[int, float] | None:
    """The split with the largest rounded gain; the first feature and smallest threshold on ties."""
    best = None
    classes = int(present.sum())
    place = np.cumsum(present) - 1
    for feature, order in enumerate(lists):
        value = x[feature][order]
        ends = np.flatnonzero(value[1:] > value[:-1])
        if not len(ends):
            continue
        own, w = place[codes[order]], None if times is None else times[order]
        total = np.bincount(own, weights=w, minlength=classes).astype(np.int64)
        gain = np.empty(len(ends))
        whole = entropies(total[None])[0]
        step = max(1, _COUNTS // classes)
        left, seen = np.zeros(classes, np.int64), 0
        for start in range(0, len(ends), step):  # a few boundaries at a time, however many classes
            part = ends[start : start + step]
            left_of = _running(own[seen : part[-1] + 1], w if w is None else w[seen : part[-1] + 1], part - seen, classes) + left
            left, seen = left_of[-1], int(part[-1]) + 1
            n_left, n = left_of.sum(axis=1), total.sum()
            after = (n_left / n) * entropies(left_of) + ((n - n_left) / n) * entropies(total - left_of)
            gain[start : start + step] = np.round(whole - after, GAIN_PLACES) + 0.0
        at = int(gain.argmax())
        if best is None or gain[at] > best[0]:
            best = gain[at], feature, float((value[ends[at]] + value[ends[at] + 1]) / 2)
    return None if best is None else best[1:]


def _running(codes: np.ndarray, times: np.ndarray | None, ends: np.ndarray, classes: int) -> np.ndarray:
    """Counts of each class up to each of some places, both ends included."""
    if len(codes) * classes <= _FEW:  # a call per class would cost more than the counting
        each = np.zeros((len(codes), classes), np.int64)
        each[np.arange(len(codes)), codes] = 1 if times is None else times
        return np.cumsum(each, axis=0)[ends]
    out = np.empty((len(ends), classes), np.int64)
    for c in range(classes):
        out[:, c] = np.cumsum(codes == c if times is None else np.where(codes == c, times, 0))[ends]
    return out


def entropies(counts: np.ndarray) -> np.ndarray:
    """-sum p log2 p of each row of class counts, added in class order."""
    by_class = np.ascontiguousarray(counts.T)  # a sum over the outer axis adds one class after the other
    with np.errstate(divide="ignore", invalid="ignore"):
        p = by_class / by_class.sum(axis=0)
        return -np.where(by_class > 0, p * np.log2(p), 0.0).sum(axis=0)
