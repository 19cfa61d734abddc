"""The best splits of large nodes: counts per range of values, and single values only where a better split may hide.

Rows are packed into chunks that Spark moves as they are, and a task walks a chunk's rows down the large nodes that
there are. Each feature's values are cut into ranges at quantiles, the finer the fewer nodes are open. Rows stay where
they are; a task sends class counts per node, feature and range. A split at the border of two ranges is known from these alone.
For one inside a range the gain has an upper bound: a side's entropy is concave in its counts, so each row of the range, put
on its better side, adds at least what it would to the side with all of the range's rows of its class. Only ranges whose
bound reaches the best border are read again, value by value. Where the ranges lie does not change the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.splits import GAIN_PLACES
from tabprep.plans.subtree import entropies
from tabprep.session import cut

#: Ranges of a feature at most, and that it keeps however many nodes are open; rows of a range above which there are more.
RANGES, FEWEST, RANGE_ROWS = 1 << 14, 256, 1 << 20
#: Numbers of counts that a task sends, those it holds, and values it holds of ranges that are read again.
SENT, HELD, VALUES = 1 << 20, 1 << 22, 1 << 21
#: Values of a chunk of rows; rows of ranges that one task searches, and numbers of counts it makes at once.
CHUNK, SEARCHED, COUNTS = 1 << 18, 1 << 18, 1 << 21
#: Tasks whose counts are added up at once.
TASKS = 64
#: Far above the error of a gain and far below a difference that counts.
SLACK = 1e-9

#: Large nodes that have been split: feature and threshold by node id.
Splits = Mapping[int, tuple[int, float]]


class Best(NamedTuple):
    """A node's split. ``left`` holds the class counts and the rows left of it, or nothing if they have to be counted."""

    feature: int
    threshold: float
    left: np.ndarray | None


def packed(rows: DataFrame, features: Sequence[str], classes: Sequence[int]) -> DataFrame:
    """``(x, y, w)``: chunks of the rows ``(*features, _y, _w)``, features by rows with nan for missing values; labels by place."""
    names, labels, most = list(features), np.array(classes), max(1, CHUNK // max(1, len(features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunks(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            done = 0
            while table.num_rows - done >= (1 if last else most):
                part = table.slice(done, most)
                # 0.0 for -0.0
                x = [part.column(f).to_numpy().astype(float) + 0.0 for f in names]
                y = np.searchsorted(labels, part.column("_y").to_numpy()).astype(np.int16)
                each = [np.stack(x).tobytes() if x else b"", y.tobytes(), part.column("_w").to_numpy().astype(np.int64).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in each], names=["x", "y", "w"])
                done += most
            held[:] = table.slice(done).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= most:
                yield from chunks(False)
        if held:
            yield from chunks(True)

    return rows.select(*names, "_y", "_w").mapInArrow(run, "x binary, y binary, w binary")


def unpacked(batches: Iterable[pa.RecordBatch | pa.Table], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The chunks' arrays: features by rows, classes, numbers of each row."""
    for batch in batches:
        for x, y, w in zip(*(batch.column(c) for c in "xyw"), strict=True):
            y = np.frombuffer(y.as_buffer(), np.int16)
            yield np.frombuffer(x.as_buffer(), float).reshape(features, len(y)), y, np.frombuffer(w.as_buffer(), np.int64)


def walked(x: np.ndarray, n: int, splits: Splits) -> Iterator[tuple[int, np.ndarray]]:
    """The nodes that the rows of a chunk come to, each with its rows. A missing value goes right."""
    todo = [(1, np.arange(n))]
    while todo:
        node, own = todo.pop()
        if node not in splits:
            yield node, own
            continue
        feature, threshold = splits[node]
        right = ~(x[feature][own] <= threshold)
        todo += [(child, part) for child, part in ((2 * node, own[~right]), (2 * node + 1, own[right])) if len(part)]


def totals(chunks: DataFrame, features: int, classes: int, splits: Splits, nodes: Iterable[int]) -> dict[int, np.ndarray]:
    """Class counts and the number of rows of each of some nodes."""
    wanted = frozenset(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for x, y, w in unpacked(batches, features):
            for node, own in walked(x, len(y), splits):
                if node in wanted:
                    n = held.setdefault(node, np.zeros(classes + 1, np.int64))
                    np.add.at(n, y[own], w[own])
                    n[-1] += len(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([n.tolist() for n in held.values()], pa.list_(pa.int64()))], names=["node_id", "n"])

    each = chunks.mapInArrow(run, "node_id bigint, n array<bigint>").select("node_id", F.posexplode("n").alias("at", "n"))
    found: dict[int, np.ndarray] = {}
    for r in each.groupBy("node_id", "at").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r.node_id, np.zeros(classes + 1, np.int64))[r["at"]] = r.n
    return found


def ranges(chunks: DataFrame, features: int, classes: int, rows: int) -> list[np.ndarray]:
    """Upper ends of each feature's ranges, near quantiles of all rows; values above the last are one range more.

    A chunk sends some of its ordered values with the number of rows each stands for.
    """
    n = max(2, min(RANGES, max(FEWEST, SENT // (features * classes))), rows // RANGE_ROWS)
    some = max(16, 4 * n * (CHUNK // features) // max(1, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, _ in unpacked(batches, features):
            for f, values in enumerate(x):
                v = np.sort(values[~np.isnan(values)])
                if len(v):
                    # the last value of each of so many equal parts
                    ends = np.unique((np.arange(1, min(some, len(v)) + 1) * len(v)) // min(some, len(v))) - 1
                    weights = np.diff(ends, prepend=-1)
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([v[ends].tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary())], names=["f", "v", "n"])

    def merged(table: pa.Table) -> pa.Table:
        v = np.concatenate([np.frombuffer(b.as_buffer(), float) for b in table.column("v")])
        rows = np.concatenate([np.frombuffer(b.as_buffer(), np.int64) for b in table.column("n")])
        order = np.argsort(v, kind="stable")
        upto = np.cumsum(rows[order])
        at = np.searchsorted(upto, np.arange(1, n) * upto[-1] / n)
        return pa.table([pa.array([table.column("f")[0].as_py()], pa.int32()), pa.array([np.unique(v[order][at]).tobytes()], pa.binary())], names=["f", "ends"])

    found = chunks.mapInArrow(run, "f int, v binary, n binary").groupBy("f").applyInArrow(merged, "f int, ends binary").collect()
    by_feature = {r.f: np.frombuffer(r.ends, float) for r in found}
    return [by_feature.get(f, np.zeros(0)) for f in range(features)]


def _coarse(ends: Sequence[np.ndarray], nodes: int, classes: int) -> list[np.ndarray]:
    """Every so manieth end, so that the counts of all nodes are no more than may be sent; some stay whatever that makes."""
    step = -(-nodes * (classes + 1) * sum(len(e) + 1 for e in ends) // SENT)
    return [e[s - 1 :: s] for e in ends for s in [max(1, min(step, len(e) // FEWEST))]]


def best_splits(chunks: DataFrame, features: int, classes: int, ends: Sequence[np.ndarray], splits: Splits, nodes: Iterable[int]) -> dict[int, Best]:
    """The split of the largest gain of each of some nodes; none where no feature has two values.

    Ties go to the first feature, then the smallest threshold. The driver holds the open nodes and the ranges read again.
    """
    wanted = sorted(nodes)
    ends = _coarse(ends, len(wanted), classes)
    of = cut(_borders(chunks, features, classes, ends, splits, frozenset(wanted)))
    found = [tuple(r) for r in of.select("node_id", "feature_no", "gain", "threshold", "exact", "left").collect()]
    most: dict[int, float] = dict.fromkeys(wanted, -1.0)
    for node, _, gain, *_ in found:
        most[node] = max(most[node], -1.0 if gain is None else gain)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node_id", "feature_no", "range", "block", "total", "before"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            rows = [
                (r["node_id"], r["feature_no"], x["range"], x["block"], r["total"], x["before"])
                for r in batch.to_pylist() for x in r["ranges"] if x["bound"] >= most[r["node_id"]] - SLACK
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    judged = of.select("node_id", "feature_no", "total", "ranges")
    open_ = judged.mapInArrow(near, "node_id bigint, feature_no int, range int, block int, total array<bigint>, before array<bigint>")
    again = [tuple(r) for r in open_.select("node_id", "feature_no", "range", "block").collect()]
    if again:
        found += [tuple(r) for r in _inside(chunks, features, classes, ends, splits, open_, again).collect()]
    best: dict[int, tuple] = {}
    for node, feature, gain, threshold, exact, left in found:
        if gain is not None:
            rank = gain, -feature, -threshold
            if node not in best or rank > best[node][0]:
                best[node] = rank, Best(feature, threshold, np.array(left) if exact else None)
    return {node: b for node, (_, b) in best.items()}


def _gains(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Rounded gains of splits by their class counts left of them and in all."""
    n_left, n, right = left.sum(axis=1), total.sum(axis=1), total - left
    after = (n_left / n) * entropies(left) + ((n - n_left) / n) * entropies(right)
    return np.round(entropies(total) - after, GAIN_PLACES) + 0.0


def _least(side: np.ndarray, more: np.ndarray) -> np.ndarray:
    """What a row of each class adds at least to the entropy (times rows) of a side that gets some of a range's rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        each = np.log2(side.sum(axis=1, keepdims=True) / (side + more))
    return np.where(np.isfinite(each), np.maximum(each, 0.0), 0.0)


def _between(low: float, high: float) -> tuple[float, bool]:
    """The threshold between two neighbouring values, and whether it parts them: it may be rounded up to the higher one."""
    with np.errstate(over="ignore", invalid="ignore"):
        threshold = float((low + high) / 2)
    return threshold, bool(low <= threshold < high)


def _borders(chunks: DataFrame, features: int, classes: int, ends: Sequence[np.ndarray], splits: Splits, wanted: frozenset[int]) -> DataFrame:
    """Per node and feature the best split between two ranges, and what a split inside each may gain.

    Counts are of the classes, then of the rows, in all (``total``), left of the split and before a range. ``block`` tells
    which ranges one task searches.
    """
    k, searched = classes, SEARCHED
    widths = [len(e) + 1 for e in ends]
    room = max(1, HELD // (sum(widths) * (k + 3)))

    columns = ["node_id", "feature_no", "task", "used", "counts", "low", "high"]

    def record(node: int, f: int, task: int, used: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
        each = [a.tobytes() for a in (used, n[used], low[used], high[used])]
        return [pa.array([node], pa.int64()), pa.array([f], pa.int32()), pa.array([task], pa.int32()), *[pa.array([b], pa.binary()) for b in each]]

    def summed(f: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, low, high = np.zeros((widths[f], k + 1), np.int64), np.full(widths[f], np.inf), np.full(widths[f], -np.inf)
        for used, counts, lows, highs in zip(*(table.column(c) for c in columns[3:]), strict=True):
            at = np.frombuffer(used.as_buffer(), np.int64)
            n[at] += np.frombuffer(counts.as_buffer(), np.int64).reshape(-1, k + 1)
            low[at] = np.minimum(low[at], np.frombuffer(lows.as_buffer(), float))
            high[at] = np.maximum(high[at], np.frombuffer(highs.as_buffer(), float))
        return n, low, high

    def added(key: tuple, table: pa.Table) -> pa.Table:
        node, f, task = (v.as_py() for v in key)
        n, low, high = summed(f, table)
        return pa.table(record(node, f, task, np.flatnonzero(n[:, k]), n, low, high), names=columns)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        task = TaskContext.get().partitionId()

        def sent() -> Iterator[pa.RecordBatch]:
            for node, arrays in held.items():
                for f, (n, low, high) in enumerate(arrays):
                    used = np.flatnonzero(n[:, k])
                    if len(used):
                        yield pa.RecordBatch.from_arrays(record(node, f, task, used, n, low, high), names=columns)
            held.clear()

        for x, y, w in unpacked(batches, features):
            for node, own in walked(x, len(y), splits):
                if node not in wanted:
                    continue
                if node not in held:
                    if len(held) >= room:
                        yield from sent()
                    held[node] = [(np.zeros((m, k + 1), np.int64), np.full(m, np.inf), np.full(m, -np.inf)) for m in widths]
                whole = len(own) == len(y)
                c, times = (y, w) if whole else (y[own], w[own])
                for f, (n, low, high) in enumerate(held[node]):
                    v = x[f] if whole else x[f][own]
                    of, by = c, times
                    if len(gone := np.flatnonzero(np.isnan(v))):
                        v, of, by = (np.delete(a, gone) for a in (v, of, by))
                    r = np.searchsorted(ends[f], v)
                    flat, at = n.reshape(-1), r * (k + 1)
                    np.add.at(flat, at + of, by)
                    np.add.at(flat, at + k, 1)
                    np.minimum.at(low, r, v)
                    np.maximum.at(high, r, v)
        yield from sent()

    def judged(key: tuple, table: pa.Table) -> pa.Table:
        n, low, high = summed(key[1].as_py(), table)
        used = np.flatnonzero(n[:, k])
        with_rows, low, high = n[used], low[used], high[used]
        n = with_rows[:, :k]
        upto, total = np.cumsum(n, axis=0), n.sum(axis=0)
        whole, size = entropies(total[None])[0], total.sum()
        cost = lambda c: c.sum(axis=1) * entropies(c) / size
        gain, threshold, exact, left = None, None, None, None
        before = np.cumsum(with_rows, axis=0) - with_rows
        if len(used) > 1:
            gains = _gains(upto[:-1], np.broadcast_to(total, upto[:-1].shape))
            i = int(gains.argmax())
            gain, left = float(gains[i]), before[i + 1].tolist()
            threshold, exact = _between(high[i], low[i + 1])
        bound = whole - (cost(upto - n) + cost(total - upto) + (n * np.minimum(_least(upto - n, n), _least(total - upto, n))).sum(axis=1) / size)
        near = np.flatnonzero((low < high) & (bound >= (-1.0 if gain is None else gain) - SLACK))
        block = np.cumsum(with_rows[near, k]) // searched
        kept = [{"range": int(used[i]), "bound": float(bound[i]), "before": before[i].tolist(), "block": int(b)} for i, b in zip(near, block, strict=True)]
        counts = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_(), counts, counts]
        kinds.append(pa.list_(pa.struct([("range", pa.int32()), ("bound", pa.float64()), ("before", counts), ("block", pa.int32())])))
        values = [key[0].as_py(), key[1].as_py(), gain, threshold, exact, left, total.tolist(), kept]
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["node_id", "feature_no", "gain", "threshold", "exact", "left", "total", "ranges"])

    schema = "node_id bigint, feature_no int, task int, used binary, counts binary, low binary, high binary"
    sums = chunks.mapInArrow(counted, schema)
    tasks = chunks.rdd.getNumPartitions()
    while tasks > TASKS:
        tasks = -(-tasks // TASKS)
        sums = sums.withColumn("task", F.col("task") % tasks).groupBy("node_id", "feature_no", "task").applyInArrow(added, schema)
    kept = "array<struct<range: int, bound: double, before: array<bigint>, block: int>>"
    return sums.groupBy("node_id", "feature_no").applyInArrow(
        judged, f"node_id bigint, feature_no int, gain double, threshold double, exact boolean, left array<bigint>, total array<bigint>, ranges {kept}"
    )


def _inside(
    chunks: DataFrame, features: int, classes: int, ends: Sequence[np.ndarray], splits: Splits, open_: DataFrame, again: list[tuple[int, int, int, int]]
) -> DataFrame:
    """``node_id, feature_no, gain, threshold, exact, left`` of the best split inside some ranges that one task searches."""
    k, most, step = classes, VALUES, max(1, COUNTS // (classes + 1))
    wanted: dict[int, dict[int, np.ndarray]] = {}  # the task of each range of a node's feature, or -1
    for node, f, r, block in again:
        by_feature = wanted.setdefault(node, {})
        if f not in by_feature:
            by_feature[f] = np.full(len(ends[f]) + 1, -1, np.int32)
        by_feature[f][r] = block

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (node, f), parts in held.items():
                arrays = [np.concatenate(a) for a in zip(*parts, strict=True)]
                blocks = wanted[node][f][arrays[0]]
                order = np.argsort(blocks, kind="stable")
                arrays, blocks = [a[order] for a in arrays], blocks[order]
                borders = np.flatnonzero(np.diff(blocks, prepend=-1))
                for start, stop in zip(borders.tolist(), [*borders[1:].tolist(), len(blocks)], strict=True):
                    each = [pa.array([a[start:stop].tobytes()], pa.binary()) for a in arrays]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node], pa.int64()), pa.array([f], pa.int32()), pa.array([int(blocks[start])], pa.int32()), *each],
                        names=["node_id", "feature_no", "block", "range", "value", "y", "w"],
                    )
            held.clear()

        size = 0
        for x, y, w in unpacked(batches, features):
            for node, own in walked(x, len(y), splits):
                for f, block in wanted.get(node, {}).items():
                    v = x[f][own]
                    r = np.searchsorted(ends[f], v)
                    some = np.flatnonzero((block[r] >= 0) & ~np.isnan(v))
                    if len(some):
                        rows = own[some]
                        held.setdefault((node, f), []).append((r[some].astype(np.int32), v[some], y[rows], w[rows]))
                        size += len(some)
                    if size >= most:
                        yield from sent()
                        size = 0
        yield from sent()

    def searched(key: tuple, table: pa.Table, opened: pa.Table) -> pa.Table:
        def all_of(c: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)])

        counts = pa.list_(pa.int64())
        names, kinds = ["node_id", "feature_no", "gain", "threshold", "exact", "left"], [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_(), counts]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        r, value, y, w = all_of("range", np.int32), all_of("value", float), all_of("y", np.int16), all_of("w", np.int64)
        order = np.argsort(value, kind="stable")  # ranges come in the order of their values
        r, value, y, w = (a[order] for a in (r, value, y, w))
        first = np.flatnonzero(np.diff(r, prepend=-1))
        given = {o: b for o, b in zip(opened.column("range").to_pylist(), opened.column("before").to_pylist(), strict=True)}
        last = np.flatnonzero((value[1:] > value[:-1]) & (r[1:] == r[:-1]))  # of the rows left of a split
        total = np.array(opened.column("total")[0].as_py())
        upto, base, best = np.zeros(k + 1, np.int64), np.zeros((1, k + 1), np.int64), None
        for start in range(0, len(value), step):  # a few rows at a time, however many classes
            part = slice(start, start + step)
            n = np.zeros((len(value[part]), k + 1), np.int64)
            n[np.arange(len(n)), y[part]] = w[part]
            n[:, k] = 1
            runs = upto + np.cumsum(n, axis=0)
            own = first[np.searchsorted(first, start) : np.searchsorted(first, start + step)]
            # what to add to a running count for the counts before the range it stands in
            base = np.concatenate([base[-1:], np.array([given[o] for o in r[own].tolist()], np.int64).reshape(-1, k + 1) - (runs - n)[own - start]])
            at = last[np.searchsorted(last, start) : np.searchsorted(last, start + step)]
            upto = runs[-1]
            if len(at):
                left = runs[at - start] + base[np.searchsorted(own, at, side="right")]
                gains = _gains(left[:, :k], np.broadcast_to(total, (len(left), k)))
                i = int(gains.argmax())
                if best is None or gains[i] > best[0]:
                    best = float(gains[i]), *_between(value[at[i]], value[at[i] + 1]), left[i].tolist()
        if best is None:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        values = [key[0].as_py(), key[1].as_py(), *best]
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

    by = ["node_id", "feature_no", "block"]
    values = chunks.mapInArrow(read, "node_id bigint, feature_no int, block int, range binary, value binary, y binary, w binary")
    return values.groupBy(*by).cogroup(open_.groupBy(*by)).applyInArrow(
        searched, "node_id bigint, feature_no int, gain double, threshold double, exact boolean, left array<bigint>"
    )


def dealt(chunks: DataFrame, features: int, splits: Splits, nodes: Iterable[int], run: Callable[[int, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """What a function makes of all rows of each of some nodes, which move once to the task that runs it."""
    wanted = frozenset(nodes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, w in unpacked(batches, features):
            for node, own in walked(x, len(y), splits):
                if node in wanted:
                    each = [np.ascontiguousarray(x[:, own]), y[own], w[own]]
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in each]], names=["node_id", "x", "y", "w"])

    def grown(key: tuple, table: pa.Table) -> pa.Table:
        x, y, w = zip(*unpacked([table], features), strict=True)
        return run(key[0].as_py(), np.concatenate(x, axis=1), np.concatenate(y), np.concatenate(w))

    return chunks.mapInArrow(read, "node_id bigint, x binary, y binary, w binary").groupBy("node_id").applyInArrow(grown, schema)
