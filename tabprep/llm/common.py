"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.session import scratch_path

#: Bytes of text a task works on at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet into the shared folder and read back.

    Cuts the lineage: later reads neither repeat the work nor depend on the executors
    that did it, and what a task numbered stays as it was numbered.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, stored with a number of their own in a new column, and the column's name.

    Numbers tell rows apart whose keys are null or repeat, and stay the same in later reads.
    """
    column = "row"
    while column.lower() in {c.lower() for c in df.columns}:
        column += "_"
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name), column


def text_of(column: str) -> F.Column:
    """The text; a null reads as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a slice holds at most ``most`` bytes of one column, or one row."""
    for batch in batches:
        ends = np.cumsum(lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text or binary value; a null has none."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and the n + 1 borders of its rows.

    The values stand as Arrow holds them: no copy is made. Nulls are empty.
    """
    if column.null_count:
        import pyarrow.compute as pc

        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(borders):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], dict], schema: str, sized: int = 1) -> DataFrame:
    """``mapInArrow`` of a function from a slice of rows to columns by name.

    ``sized`` is the position of the column whose bytes bound a slice.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    parsed = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(parsed)
        for part in slices(batches, sized):
            out = f(part)
            yield pa.RecordBatch.from_arrays([pa.array(out[n.name], type=n.type) if not isinstance(out[n.name], pa.Array) else out[n.name].cast(n.type) for n in arrow], schema=arrow)

    return df.mapInArrow(run, schema)
