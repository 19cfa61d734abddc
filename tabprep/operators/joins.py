"""Joins of result tables, dictionaries and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.session import cut

# A dictionary side is broadcast only up to this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 200_000_000
# A key is hot above this many rows and above one in MOST_HOT of all rows, so at most MOST_HOT keys
# are. Its rows spread over as many tasks as that makes pieces of HOT_ROWS.
HOT_ROWS = 100_000
MOST_HOT = 10_000
# Bits of a bitmap per key, as long as its words are no more than may be broadcast; fewer let more rows
# through that match nothing.
BITS_A_KEY = 16
MOST_WORDS = 1 << 19
# Rows without a key match nothing and need no copies, so they spread freely.
FREE = 1 << 20


def fits(dim: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes of text form; reads one row more than that at most."""
    width = F.octet_length(F.to_json(F.struct(*dim.columns)))
    # widths alone go to the one task that counts them
    n, total = dim.select(width.alias("width")).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("width")).first()
    return n <= rows and (total or 0) <= size


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


class KeyBitmap:
    """A set of keys as one bit each, with false members, in words of 64 bits: at most ``MOST_WORDS`` rows to broadcast.

    Built from counts and ``bit_or``; a row is tested in the JVM.
    """

    def __init__(self, keys: DataFrame, columns: Sequence[str], most_words: int | None = None):
        wanted = max(1, keys.count() * BITS_A_KEY)
        most = (most_words or MOST_WORDS) * 64
        self.bits = max(6, min(wanted, most).bit_length() - (wanted >= most))
        place = _place(columns, self.bits)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
        self.words = cut(keys.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(bit).alias("_set")))

    def split(self, df: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
        """Rows that may be members (``left_semi``), or those that are not (``left_anti``)."""
        place = _place([f"_rows.`{c}`" for c in columns], self.bits)
        there = (F.shiftright(place, 6) == F.col("_map._word")) & (F.getbit("_map._set", place.bitwiseAND(63).cast("int")) == 1)
        return df.alias("_rows").join(F.broadcast(self.words).alias("_map"), there, how).select("_rows.*")


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    salt_by: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    dim_rows: int | None = None,
) -> DataFrame:
    """Join rows to a table that is unique on ``on``; ``how`` is ``left`` or ``inner``.

    A ``dim`` that ``fits`` is broadcast. Otherwise a bitmap of its keys tells which rows of ``df`` may match:
    the others do not move. Of those that may, the keys are counted; rows of a hot key carry one of as many
    salts as their number asks for, and only the hot rows of ``dim`` are repeated, once per
    salt. ``df`` is read three times, for the counts its keys alone, and never stored. ``salt_by`` should
    differ from row to row. A caller that knows a table of a few numbers per row gives its
    ``dim_rows`` instead.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits(dim, broadcast_rows) if dim_rows is None else dim_rows <= broadcast_rows:
        return df.join(F.broadcast(dim), keys, how)
    known = KeyBitmap(dim, keys)
    may = known.split(df, keys, "left_semi")
    counts = cut(may.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    salts = F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias("_salts")
    hot = counts.filter(F.col("_n") > max(HOT_ROWS, total // MOST_HOT)).select(*keys, salts)
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # at most MOST_HOT rows are broadcast
    ways = F.when(unmatched, F.lit(FREE)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = salt_by if salt_by is not None else F.monotonically_increasing_id()
    marked = may.join(F.broadcast(hot), keys, "left")
    salted = marked.withColumn("_salt", F.pmod(F.xxhash64(spread), ways).cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = dim.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    joined = salted.join(copies, [*keys, "_salt"], how).drop("_salt")
    if how == "inner":
        return joined
    alone = known.split(df, keys, "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema if f.name not in keys]
    return joined.unionByName(alone.select("*", *nothing))


def align(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Line up one value column of several tables of the same samples, by key."""
    named = [t.select(key, F.col(value).alias(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key), named)


def not_in(df: DataFrame, other: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows whose value does not occur in ``other``; a NULL value is kept.

    Only digests (SHA-256) of values move. Those of ``other`` are broadcast if they fit. Otherwise rows whose
    digest is not in a bitmap of them are kept where they are. The digests of the rest are looked up once each; those that are not in ``other``
    after all, one in thousands, are broadcast, and their rows kept too. If there are too
    many of these for that, their rows are joined by digest, spread by ``key``, a row key of ``df``.
    """
    digest = F.sha2(F.col(on).cast("string"), 256)
    seen = cut(other.filter(F.col(on).isNotNull()).select(digest.alias("_digest")).distinct())
    named = df.withColumn("_digest", digest)
    if fits(seen):
        return named.join(F.broadcast(seen), "_digest", "left_anti").drop("_digest")
    known = KeyBitmap(seen, ["_digest"])
    may = known.split(named.select("_digest").filter(F.col("_digest").isNotNull()), ["_digest"], "left_semi")
    wrong = cut(may.distinct().join(seen, "_digest", "left_anti"))
    salt = F.col(key) if key else None
    kept = lookup_join(known.split(named, ["_digest"], "left_semi"), wrong, "_digest", "inner", salt)
    lone = named.filter(F.col("_digest").isNull())
    rest = known.split(named.filter(F.col("_digest").isNotNull()), ["_digest"], "left_anti")
    return rest.unionByName(kept).unionByName(lone).drop("_digest")


def strip_suffix(c: Column | str, suffix: str) -> Column:
    """The text before the first occurrence of ``suffix``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring_index(c, suffix, 1)


def key_match_count(
    a: DataFrame, b: DataFrame, row: str, key_a: str, suffix_a: str, key_b: str, suffix_b: str
) -> DataFrame:
    """``matches``: rows of the two tables, paired by ``row``, whose keys agree without their suffixes."""
    left = a.select(row, strip_suffix(key_a, suffix_a).alias("_a"))
    right = b.select(row, strip_suffix(key_b, suffix_b).alias("_b"))
    return left.join(right, row).agg(F.count_if(F.col("_a") == F.col("_b")).alias("matches"))
