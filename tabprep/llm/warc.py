"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a skippable frame at the end of the file holds
the seek table (compressed and plain size of each frame), in the published seekable format.
The index maps a record to its file, frame and offset within the plain frame, so one record
costs one frame.

Equal payloads are stored once: the record with the smallest key is the response, the others
are revisits that name it and hold headers only.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import slices, stored, text_of
from tabprep.llm.decontaminate import Bitmap
from tabprep.llm.files import new_folder, new_name, reader, write

#: Plain bytes after which a frame, and compressed bytes after which a file is closed.
FRAME, FILE = 256 << 10, 32 << 20
#: Fixed values of the seekable format: the skippable frame's and the footer's magic numbers.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Fixed value: the profile of revisits.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this length are always stored.
LEAST = 100
#: Tasks at most that read files; as many as files up to here.
MOST_TASKS = 20_000


class Bundle:
    """A seekable file being written."""

    def __init__(self):
        import zstandard

        self.press = zstandard.ZstdCompressor(level=3)
        self.done: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.plain = self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The record's frame and its offset there."""
        place = len(self.sizes), self.plain
        self.open.append(record)
        self.plain += len(record)
        if self.plain >= FRAME:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.open:
            frame = self.press.compress(b"".join(self.open))
            self.done.append(frame)
            self.sizes.append((len(frame), self.plain))
            self.size += len(frame)
            self.open, self.plain = [], 0

    def content(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(table) + len(footer))
        return b"".join([*self.done, head, table, footer])


class Frames:
    """A seekable file being read, one frame in memory at a time."""

    def __init__(self, address: str):
        import zstandard

        self.file = reader(address)
        size = self.file.size()
        self.file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{address} has no seek table")
        self.file.seek(size - 9 - 8 * frames)
        self.sizes = list(struct.iter_unpack("<II", self.file.read(8 * frames)))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.unpress = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, frame: int) -> bytes:
        self.file.seek(self.starts[frame])
        packed, plain = self.sizes[frame]
        return self.unpress.decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def record_id(key: object) -> str:
    return f"<urn:page:{key}>"


def record(key: object, url: str | None, payload: bytes, length: int, digest: str, kind: str, refers: object, date: str) -> bytes:
    """One record: WARC headers, and an HTTP response as its block; a revisit's has no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {date}"]
    if url is not None:
        # blanks and control characters may not stand in a header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers (names in lower case) and payload of each record of a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        first, *lines = frame[at:end].decode().split("\r\n")
        if first != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines)}
        start = end + 4
        block = frame[start : start + int(head["content-length"])]
        body = block.index(b"\r\n\r\n") + 4
        yield head, block[body:]
        at = start + len(block) + 4


def write_archives(pages: DataFrame, key: str, url: str, payload: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a record and return the index: ``key, file, frame, offset, length``.

    Null payloads are empty, a null url is left out. Of payloads of at least LEAST bytes that
    are equal, the row with the smallest key is the response; rows that repeat this key are
    responses too. A null key is never the smallest. An empty table gives an empty index.

    Rows whose payload occurs once are archived where they are read. Which payloads occur again, and which
    rows are their responses, is told from keys and digests; revisits need no payload and are
    archived from there. Only payloads of responses that have revisits move, and those that the
    bitmaps of digests and of responses let through wrongly, about one in 32. Beyond half a million
    repeated payloads the bitmaps (see ``decontaminate.Bitmap``) let more through; the result is the same.
    """
    where = new_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), text_of(payload).alias("payload")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256)
    )
    rows = rows.select("*", F.octet_length("payload").alias("bytes"), F.xxhash64("digest").alias("mark"), F.xxhash64("digest", "key").alias("pair"))
    first = stored(
        rows.filter(F.col("bytes") >= LEAST).groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").select("digest", "least"), "repeated"
    )
    repeated = Bitmap(first.select(F.xxhash64("digest").alias("mark")), "mark")
    again = F.col("least").isNotNull() & ~F.col("key").eqNullSafe(F.col("least"))
    narrow = _in(rows.select("key", "url", "digest", "bytes", "mark", "pair"), repeated=repeated)
    fate = stored(narrow.join(first, "digest", "left").withColumn("again", again), "fate")
    responses = Bitmap(fate.filter("NOT again").select("pair").distinct(), "pair")
    columns = ["key", "payload", "url", "digest", "bytes", "refers"]
    revisits = fate.filter("again").withColumns({"payload": F.lit(""), "refers": F.col("least")}).select(columns)
    nobody = F.lit(None).cast(pages.schema[key].dataType)
    moved = _in(rows, repeated=repeated, responses=responses).join(first, "digest", "left").filter(~again).withColumn("refers", nobody).select(columns)
    alone = _in(rows, alone=repeated).withColumn("refers", nobody).select(columns)
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index, names = Bundle(), [], ["key", "file", "frame", "offset", "length"]
        kinds = None

        def close() -> pa.RecordBatch:
            address = new_name(where, ".warc.zst")
            write(address, bundle.content())
            keys, frames, offsets, sizes = zip(*index, strict=True)
            columns = [pa.array(keys, kinds), pa.array([address] * len(keys)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for part in slices(batches, 1):
            kinds = part.column(0).type
            for k, body, address, digest, length, refers in zip(*(c.to_pylist() for c in part.columns), strict=True):
                made = record(k, address, body.encode(), length, digest, "response" if refers is None else "revisit", refers, date)
                index.append((k, *bundle.add(made), len(made)))
                if bundle.size >= FILE:
                    yield close()
                    bundle, index = Bundle(), []
        if index:
            yield close()

    schema = f"key {kind}, file string, frame int, offset bigint, length bigint"
    told = alone.mapInArrow(run, schema).union(revisits.union(moved).mapInArrow(run, schema))
    return stored(told, "warc-index").withColumnRenamed("key", key)


def _in(rows: DataFrame, repeated: Bitmap | None = None, responses: Bitmap | None = None, alone: Bitmap | None = None) -> DataFrame:
    """The rows whose digest, or digest and key, may be in a bitmap; or those whose digest is not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = batch.column("mark").to_numpy().view(np.uint64)
            kept = np.ones(len(mark), bool)
            if alone is not None:
                kept &= ~alone.has(mark)
            if repeated is not None:
                kept &= repeated.has(mark)
            if responses is not None:
                kept &= responses.has(batch.column("pair").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(kept))

    return rows.mapInArrow(run, rows.schema)


def read_archives(index: DataFrame) -> DataFrame:
    """``id, type, refers_to, payload_bytes, payload_digest`` of every record, from the files.

    The payload's length and digest are taken of the bytes read; a revisit has no payload of
    its own. A task reads whole files, one frame at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column(0).to_pylist():
                file = Frames(address)
                for frame in range(len(file)):
                    out = []
                    for head, payload in parse(file[frame]):
                        own = head["warc-type"] != "revisit"
                        out.append({
                            "id": head["warc-record-id"], "type": head["warc-type"], "refers_to": head.get("warc-refers-to"),
                            "payload_bytes": len(payload) if own else None, "payload_digest": hashlib.sha256(payload).hexdigest() if own else None,
                            "told": head["warc-payload-digest"].removeprefix("sha256:"),
                        })
                    yield pa.RecordBatch.from_pylist(out, schema=READ)
                file.close()

    names = index.select("file").distinct()
    files = names.repartition(min(MOST_TASKS, max(1, names.count())))
    return files.mapInArrow(run, "id string, type string, refers_to string, payload_bytes bigint, payload_digest string, told string")


READ = pa.schema([("id", pa.string()), ("type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("told", pa.string())])


def resolve(records: DataFrame) -> DataFrame:
    """The records with each revisit's payload length and digest taken from the response it names.

    Records may share an id, as pages may share a key; a revisit's response is the one that also has
    its digest. A revisit without such a response fails the job.
    """
    own = records.filter("type != 'revisit'")
    named = own.groupBy(F.col("id").alias("refers_to"), F.col("payload_digest").alias("told")).agg(F.first("payload_bytes").alias("bytes"))
    again = records.filter("type = 'revisit'").join(named, ["refers_to", "told"], "left")
    sound = F.when(F.col("bytes").isNotNull(), F.col("told")).otherwise(F.raise_error(F.concat(F.lit("unresolved revisit "), "id")))
    return own.select("id", "type", "refers_to", "payload_bytes", "payload_digest").union(
        again.select("id", "type", "refers_to", F.col("bytes").alias("payload_bytes"), sound.cast("string").alias("payload_digest"))
    )


def fetch(index: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``key, record``: the stored bytes of the wanted records, each read from its frame alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, file, frame, plain = [], None, None, None, b""
            for row in zip(*(batch.column(n).to_pylist() for n in ("file", "frame", "offset", "length")), strict=True):
                if row[0] != last:
                    if file:
                        file.close()
                    last, file, frame = row[0], Frames(row[0]), None
                if row[1] != frame:
                    frame, plain = row[1], file[row[1]]
                out.append(plain[row[2] : row[2] + row[3]])
            if file:
                file.close()
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "record"])

    kind = index.schema[key].dataType.simpleString()
    found = index.join(wanted.select(key).distinct(), key).select(F.col(key).alias("key"), "file", "frame", "offset", "length")
    tasks = min(MOST_TASKS, max(1, found.select("file").distinct().count()))
    ordered = found.repartition(tasks, "file", "frame").sortWithinPartitions("file", "frame", "offset")
    return ordered.mapInArrow(run, f"key {kind}, record binary").withColumnRenamed("key", key)
