"""Secrets in text, told apart by how many owners hold the same value.

DataFrame operations only. A pattern cuts a text into gaps and matches; the places of the
matches are running sums of their lengths, made once the matches are rows, so a text with
very many of them costs no more per match. Values leave the scan as digests. Over the whole
corpus each digest is counted by distinct repositories and owners: a value that many owners
hold is a copied example, a value of one owner looks like a credential in use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import stored, text_of


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the least length of the value."""

    name: str
    pattern: str
    group: int
    least: int


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))

#: The base kinds, as fixed by their definition, in the order in which spans are listed. A run
#: of a single class that is too short holds no later match, so its least length may stand in
#: the pattern; an assignment that is too short still uses up its text.
BASE = (
    Kind("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Values without a telling form, which only their ownership makes suspicious.
OPAQUE = Kind("owned", r"[A-Za-z0-9+/_-]{20,}", 0, 20)
#: From so many owners on a value is a copied example.
EXAMPLE_OWNERS = 3


def _cut(text: F.Column, kind: Kind) -> F.Column:
    """The matches of a kind as (gap before, length, length of the value, digest of the value)."""
    pattern = F.lit(kind.pattern)
    gaps = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = whole if kind.group == 0 else F.regexp_extract_all(text, pattern, F.lit(kind.group))

    def row(pair: F.Column) -> F.Column:
        v = pair["value"]
        keeps = F.length(v) >= kind.least
        if kind is OPAQUE:
            keeps = keeps & v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
        return F.struct(
            F.length(pair["gap"]).alias("gap"), F.length(pair["whole"]).alias("len"),
            F.when(keeps, F.sha2(v, 256)).alias("digest"),
        )

    # the text behind the last match is a gap without a match
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    none = F.array().cast("array<struct<gap: int, len: int, digest: string>>")
    return F.when(text.rlike(kind.pattern), F.transform(zipped, row)).otherwise(none)


def candidates(df: DataFrame, key: str, text: str, repository: F.Column, owner: F.Column) -> DataFrame:
    """``row, key, repository, owner`` and the matches of each kind, stored: one row per row of ``df``."""
    body = text_of(text)
    cut = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        *(_cut(body, k).alias(k.name) for k in (*BASE, OPAQUE)),
    )
    return stored(cut, "candidates")


def spans(rows: DataFrame) -> DataFrame:
    """``row, kind, at, begin, end, digest, owners, repositories, verdict``: every span of ``candidates``.

    ``begin`` and ``end`` count code points, ``at`` is the kind's place in the list. Base spans
    all stay. A span of kind ``owned`` is added where one owner alone holds the value and no
    base span overlaps it. ``verdict`` is ``live`` for one owner, ``example`` from
    EXAMPLE_OWNERS on, ``shared`` between.
    """
    kinds = [*BASE, OPAQUE]
    each = [
        rows.select("row", "repository", "owner", F.lit(i).alias("at"), F.lit(k.name).alias("kind"), F.posexplode(k.name).alias("n", "m"))
        for i, k in enumerate(kinds)
    ]
    found = each[0]
    for more in each[1:]:
        found = found.union(more)
    so_far = Window.partitionBy("row", "at").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(so_far)
    placed = stored(
        found.select("row", "repository", "owner", "at", "kind", (end - F.col("m.len")).alias("begin"), end.alias("end"), F.col("m.digest").alias("digest"))
        .filter("digest is not null"),
        "spans",
    )
    held = placed.select("digest", "owner", "repository").distinct()
    counts = held.groupBy("digest").agg(F.countDistinct("owner").alias("owners"), F.count("*").alias("repositories"))
    verdict = F.when(F.col("owners") == 1, "live").when(F.col("owners") >= EXAMPLE_OWNERS, "example").otherwise("shared")
    base = F.col("at") < len(BASE)
    # base spans that begin before this one ends, and those that begin later
    upto = Window.partitionBy("row").orderBy("begin", "at").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("row").orderBy("begin", "at").rowsBetween(0, Window.unboundedFollowing)
    reach = F.coalesce(F.max(F.when(base, F.col("end"))).over(upto), F.lit(0))
    # equal begins: the added kind is the last in order, so a base span of that begin stands before it
    following = F.min(F.when(base, F.col("begin"))).over(later)
    free = (reach <= F.col("begin")) & (following.isNull() | (following >= F.col("end")))
    judged = placed.select("row", "at", "kind", "begin", "end", "digest", free.alias("free")).join(counts, "digest")
    return judged.filter(base | (F.col("free") & (F.col("owners") == 1))).select(
        "row", "kind", "at", "begin", "end", "digest", "owners", "repositories", verdict.alias("verdict")
    )


def scan(df: DataFrame, key: str, text: str, repository: F.Column, owner: F.Column) -> DataFrame:
    """``key, spans``: every whole text's spans, ordered by begin and kind.

    ``spans`` is an array of (begin, at, kind, end, digest, owners, repositories, verdict).
    Null and empty texts have none. A null repository or owner counts as one of its own.
    Every row of ``df`` gives one row, also where keys are null or repeat; copies of a row
    in one repository count once there. An empty table gives an empty result; other columns are not read.
    """
    rows = candidates(df, key, text, repository, owner)
    listed = spans(rows).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("begin", "at", "kind", "end", "digest", "owners", "repositories", "verdict"))).alias("spans")
    )
    none = F.array().cast(listed.schema["spans"].dataType)
    return rows.select("row", "key").join(listed, "row", "left").select(F.col("key").alias(key), F.coalesce("spans", none).alias("spans"))


def redact(df: DataFrame, text: str, repository: F.Column, owner: F.Column, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span but copied examples replaced by a mark; other rows and columns stay.

    Spans that overlap are replaced as one. A null text stays null. Names of other columns may clash or hold dots. Texts without spans do
    not move; a text with spans is cut in steps that each run over it.
    """
    columns = df.columns
    body = text_of(text)
    whole = F.struct(*(F.col(f"`{c}`") for c in columns))
    rows = stored(
        df.select(
            whole.alias("doc"), F.monotonically_increasing_id().alias("row"),
            F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
            *(_cut(body, k).alias(k.name) for k in (*BASE, OPAQUE)),
        ),
        "documents",
    )
    bad = spans(rows.drop("doc")).filter("verdict != 'example'")
    order = Window.partitionBy("row").orderBy("begin", "end")
    past = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(past.isNull() | (F.col("begin") >= past), 1).otherwise(0)
    runs = bad.select("row", "begin", "end", opens.alias("opens")).select("row", "begin", "end", F.sum("opens").over(order).alias("run"))
    merged = runs.groupBy("row", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    cuts = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("cuts"))
    may = F.lit(False)
    for k in (*BASE, OPAQUE):
        may = may | (F.size(k.name) > 0)
    touched = rows.filter(may).select("doc", "row").join(cuts, "row", "left").select("doc", "cuts")
    old = F.col(f"doc.`{text}`")
    before = lambda i: F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["end"])
    kept = F.transform("cuts", lambda c, i: F.concat(old.substr(before(i) + 1, c["begin"] - before(i)), F.lit(mark)))
    last = F.element_at("cuts", -1)["end"]
    new = F.when(F.col("cuts").isNull(), old).otherwise(F.concat(F.concat_ws("", kept), old.substr(last + 1, F.length(old).cast("long"))))
    done = touched.select(F.col("doc").withField(f"`{text}`", new).alias("doc")).union(rows.filter(~may).select("doc"))
    return done.select(*(F.col(f"doc.`{c}`").alias(c) for c in columns))
