"""Exact quantiles by radix selection.

A double's bits, with the sign turned, are a whole number that orders as the double does. Each
round counts one digit of these keys among the values whose leading digits are those of a wanted
rank, for all columns, groups and ranks at once; the digit whose running count reaches the rank is the
rank's next one. After four rounds of 16 bits the key is known, and so the value. Nothing is sorted and
no value is shuffled: a task sends a count per digit. A table of few values is ordered instead, in
one job rather than four.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tabprep.operators import prefix
from tabprep.session import stored

#: Groups at most whose ranks the driver holds; more are ranked by order.
MOST_GROUPS = 4096
DIGIT = 16
ROUNDS = 64 // DIGIT
#: Values (rows x columns) up to which one job orders them.
ORDERED = 1 << 20
#: Counts a task holds before it adds up those of equal digits.
HELD = 1 << 20


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), most_groups: int = MOST_GROUPS, ordered: int = ORDERED) -> DataFrame:
    """``(*by, column, n, q0..qk)``: exact quantiles with linear interpolation.

    NULLs are left out, and a column without values in a group has no row. NaN is above any
    number, -0.0 equals 0.0. A group may be NULL. The columns are stored once, as doubles, and read once a
    round. With more than ``most_groups`` groups, or up to ``ordered`` values, they are
    shuffled and ordered, with the same result.
    """
    by, cols = list(by), list(cols)
    table = stored(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]), "values")
    groups = table.select(*by).distinct().limit(most_groups + 1).collect() if by else [()]
    if len(groups) > most_groups or table.count() * len(cols) <= ordered:
        return prefix.exact_quantiles(table, cols, probs, by)
    name = F.to_json(F.struct(*by)) if by else F.lit("")
    narrow = table.select(name.alias("_group"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)])
    names = [r[0] for r in df.sparkSession.createDataFrame(groups, table.select(*by).schema).select(name).collect()] if by else [""]
    code = {g: i for i, g in enumerate(names)}
    slots = [(g, c, 0) for g in range(len(names)) for c in range(len(cols))]  # group, column, leading digits
    ranks: list[list[int]] | None = None
    found: dict[tuple[int, int], tuple[int, dict[int, int]]] = {}  # group and column: rows, and rank to leading digits
    for round in range(ROUNDS):
        after: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for r in _chosen(_digits(narrow, code, len(cols), slots, round), probs, ranks).collect():
            g, c, lead = slots[r.slot]
            digits = lead << DIGIT | r.digit
            if ranks is None:
                found[g, c] = (r.total, found.get((g, c), (0, {}))[1] | dict.fromkeys(r.ranks, digits))
                after[g, c, digits] = [(k, k - r.before) for k in r.ranks]
            else:
                own = [k for k in origin[r.slot] if k[1] in r.ranks]
                found[g, c][1].update(dict.fromkeys((k for k, _ in own), digits))
                after[g, c, digits] = [(k, local - r.before) for k, local in own]
        slots = sorted(after)
        origin = [after[s] for s in slots]
        ranks = [sorted({local for _, local in o}) for o in origin]
        if not slots:
            break
    rows = []
    for (g, c), (n, keys) in sorted(found.items()):
        values = {k: _value(key) for k, key in keys.items()}
        rows.append((*groups[g], cols[c], n, *[_between(values, n, p) for p in probs]))
    fields = [StructField("column", StringType()), StructField("n", LongType()), *[StructField(f"q{i}", DoubleType()) for i in range(len(probs))]]
    return df.sparkSession.createDataFrame(rows, StructType([*(table.schema[b] for b in by), *fields]))


def _between(values: dict[int, float], n: int, p: float) -> float:
    h = (n - 1) * float(p)
    low, high = values[math.floor(h)], values[math.ceil(h)]
    return low + (high - low) * (h - math.floor(h))


def _keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers that order as the doubles do, NaN last."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.uint64)
    sign = np.uint64(1 << 63)
    return np.where(bits & sign, ~bits, bits | sign)


def _value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return np.array([bits], np.uint64).view(np.float64)[0].item()


def _digits(narrow: DataFrame, code: dict[str, int], columns: int, slots: list[tuple[int, int, int]], round: int) -> DataFrame:
    """``(slot, digit, n)``: how often each digit follows the leading digits of a slot."""
    shift = np.uint64(64 - DIGIT * (round + 1))
    lead_bits = DIGIT * round
    of_column = []
    for c in range(columns):
        own = sorted((g << lead_bits | lead, s) for s, (g, at, lead) in enumerate(slots) if at == c)
        of_column.append((np.array([k for k, _ in own], np.uint64), np.array([s for _, s in own], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            group = np.array([code[g] for g in names.dictionary.to_pylist()], np.uint64)[names.indices.to_numpy()]
            for c, (wanted, slot) in enumerate(of_column):
                column = batch.column(c + 1)
                there = column.is_valid().to_numpy(zero_copy_only=False)
                if not len(wanted) or not there.any():
                    continue
                digits = _keys(column.drop_null().to_numpy(zero_copy_only=False)) >> shift
                key = group[there] << np.uint64(lead_bits) | (digits >> np.uint64(DIGIT))
                at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                hit = wanted[at] == key
                held.append(np.unique(slot[at[hit]] << DIGIT | (digits[hit] & np.uint64((1 << DIGIT) - 1)).astype(np.int64), return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = [_added(held)]
        keys, counts = _added(held) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys >> DIGIT, pa.int64()), pa.array(keys & (1 << DIGIT) - 1, pa.int64()), pa.array(counts, pa.int64())], names=["slot", "digit", "n"]
        )

    return narrow.mapInArrow(run, "slot bigint, digit bigint, n bigint").groupBy("slot", "digit").agg(F.sum("n").alias("n"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, place, np.concatenate([n for _, n in parts]))
    return keys, counts


def _chosen(digits: DataFrame, probs: Sequence[float], ranks: list[list[int]] | None) -> DataFrame:
    """``(slot, digit, before, total, ranks)``: digits that hold a wanted rank, and how many values come before.

    A slot has at most 2**16 digits.
    """
    whole = Window.partitionBy("slot")
    upto = whole.orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = digits.select("slot", "digit", (F.sum("n").over(upto) - F.col("n")).alias("before"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"))
    if ranks is None:
        h = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
        wanted: Column = F.array_distinct(F.array(*[f(x) for x in h for f in (F.floor, F.ceil)]))
    else:
        wanted = F.get(F.from_json(F.lit(json.dumps(ranks)), "array<array<bigint>>"), F.col("slot").cast("int"))
    held = F.filter(wanted, lambda k: (k >= F.col("before")) & (k < F.col("upto")))
    return ran.withColumn("ranks", held).filter(F.size("ranks") > 0).drop("upto")
