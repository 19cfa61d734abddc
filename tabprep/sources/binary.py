"""Binary record files as a Spark data source: tasks read byte ranges that begin and end with a record.

``fixed_records`` reads records of one label byte and a fixed number of bytes, and pairs of headered
files: one of labels, one of pictures.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes a task reads, and bytes it holds at once.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
# fixed values: the marks of unsigned bytes in one and in three dimensions
LABEL_MARK, IMAGE_MARK = 0x0801, 0x0803


@dataclass
class Range(InputPartition):
    """Some records: a file of their bytes, where its records begin, and a file of labels if they stand apart."""

    path: str
    header: int
    first: int
    records: int
    labels: str | None = None
    label_header: int = 0


def file_system(address: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a full address and the path in it; a name may hold blanks and the like."""
    return pafs.FileSystem.from_uri(quote(address, safe=":/"))


def files(address: str) -> list[tuple[str, int]]:
    """The file, or the files of the folder, at a full address, with their sizes, in the order of their names.

    Names that begin with a dot or an underscore are not data.
    """
    system, path = file_system(address)
    info = system.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(address)
    found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(path))
    scheme = address.partition("://")[0]
    head = address[: -len(path)] if address.endswith(path) else f"{scheme}://"
    data = [(head + f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
    return sorted(data)


def read_at(address: str, start: int, size: int) -> bytes:
    """Bytes of a file from a place on; fewer at its end."""
    system, path = file_system(address)
    with system.open_input_file(path) as f:
        f.seek(start)
        return f.read(size)


def header(address: str, mark: int) -> tuple[int, int]:
    """How many items a headered file tells of, and how many bytes each has."""
    sides = mark & 0xFF
    head = np.frombuffer(read_at(address, 0, 4 + 4 * sides), ">u4")
    if len(head) != 1 + sides or head[0] != mark:
        raise ValueError(f"{address} does not begin with the mark {mark:#06x} and {sides} sizes")
    return int(head[1]), int(np.prod(head[2:], dtype=np.int64))


class Records(DataSource):
    """Options: ``path`` (a full address), ``pixels`` (bytes after the label) or ``labels`` (the address of the label files), ``split``."""

    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def schema(self) -> str:
        return "file string, position bigint, label int, data binary"

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(dict(self.options))


class RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.labels = options["path"], options.get("labels")
        self.split = int(options.get("split", SPLIT_BYTES))
        self.pixels = int(options.get("pixels", 0))

    def partitions(self) -> list[Range]:
        """Ranges of whole records; headers and sizes are checked here, once."""
        return self._headered() if self.labels else self._plain()

    def _plain(self) -> list[Range]:
        size = 1 + self.pixels
        out = []
        for path, length in files(self.path):
            if length % size:
                raise ValueError(f"{path} has {length} bytes, which are no whole records of {size}")
            out += [Range(path, 0, a, n) for a, n in self._cuts(length // size, size)]
        return out

    def _headered(self) -> list[Range]:
        pictures, labels = files(self.path), files(self.labels)
        if len(pictures) != len(labels):
            raise ValueError(f"{len(pictures)} files of pictures and {len(labels)} of labels")
        out = []
        for (path, length), (named, named_length) in zip(pictures, labels, strict=True):
            (n, size), (n_labels, _) = header(path, IMAGE_MARK), header(named, LABEL_MARK)
            if n != n_labels or length < 16 + n * size or named_length < 8 + n:
                raise ValueError(f"{path} and {named} do not hold as many items as their headers tell of")
            if self.pixels and size != self.pixels:
                raise ValueError(f"{path} has pictures of {size} bytes, not {self.pixels}")
            out += [Range(path, 16, a, m, named, 8) for a, m in self._cuts(n, size)]
        self.pixels = self.pixels or (size if pictures else 0)
        return out

    def _cuts(self, records: int, size: int) -> Iterator[tuple[int, int]]:
        step = max(1, self.split // max(1, size))
        return ((a, min(step, records - a)) for a in range(0, records, step))

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, path = file_system(part.path)
        size = (0 if part.labels else 1) + (header(part.path, IMAGE_MARK)[1] if part.labels else self.pixels)
        step = max(1, BATCH_BYTES // max(1, size))
        with system.open_input_file(path) as f:
            for start in range(part.first, part.first + part.records, step):
                n = min(step, part.first + part.records - start)
                f.seek(part.header + start * size)
                raw = f.read(n * size)
                if len(raw) < n * size:
                    raise ValueError(f"{part.path} became shorter while it was read")
                records = np.frombuffer(raw, np.uint8).reshape(n, size)
                if part.labels:
                    label = np.frombuffer(read_at(part.labels, part.label_header + start, n), np.uint8)
                else:
                    label, records = records[:, 0], np.ascontiguousarray(records[:, 1:])
                width = records.shape[1]
                ends = pa.py_buffer(np.arange(0, (n + 1) * width, max(1, width), dtype=np.int32)[: n + 1] if width else np.zeros(n + 1, np.int32))
                data = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(records.tobytes())])
                name = part.path.rpartition("/")[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(start, start + n)), pa.array(label.astype(np.int32)), data], names=["file", "position", "label", "data"]
                )
