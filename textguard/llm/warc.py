"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import struct
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.session import broadcast_if_small, new_path, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 16 * 1024 * 1024
REVISIT_BYTES = 100
MOST_READERS = 20_000
# Fixed values of the seekable format: a skippable frame that ends the file.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
Batches = Iterator[pa.RecordBatch]
INDEX = "bundle string, record_id string, page_id long, frame int, offset long, length long"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload binary"
)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder named by URI or by an absolute path."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(record: str) -> int | None:
    name = record.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def render(row: dict) -> bytes:
    """One WARC record. A revisit has no block; its headers name the payload it stands for."""
    kind = "revisit" if row["revisit"] else "response"
    block = b"" if row["revisit"] else row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(row['page_id'])}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=';/?:@&=+$,#%!*()~')}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['n']}",
    ]
    if row["revisit"]:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(row['refers_to'])}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:stop].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at offset {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    first = stop + 4
    last = first + int(headers["Content-Length"])
    return headers, data[first:last], last + 4


@dataclass
class Bundle:
    """A file of independent frames, written in one go and closed by its seek table."""

    store: fs.FileSystem
    path: str
    parts: list[bytes] = field(default_factory=list)
    sizes: list[tuple[int, int]] = field(default_factory=list)
    open_frame: list[bytes] = field(default_factory=list)
    in_frame: int = 0
    written: int = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, offset in the uncompressed frame, length) of the record."""
        if self.in_frame and self.in_frame + len(record) > FRAME_BYTES:
            self.end_frame()
        place = (len(self.sizes), self.in_frame, len(record))
        self.open_frame.append(record)
        self.in_frame += len(record)
        return place

    def end_frame(self) -> None:
        if self.in_frame:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(self.open_frame))
            self.parts.append(packed)
            self.sizes.append((len(packed), self.in_frame))
            self.written += len(packed)
            self.open_frame, self.in_frame = [], 0

    def close(self) -> None:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        footer = entries + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        with self.store.open_output_stream(self.path, compression=None) as out:
            for part in self.parts:
                out.write(part)
            out.write(struct.pack("<II", SKIPPABLE, len(footer)) + footer)


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start in the file, compressed size, uncompressed size) of each frame, from the tail."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    entries = file.read_at(8 * count, size - 9 - 8 * count)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", entries):
        out.append((at, packed, plain))
        at += packed
    return out


def _frame(file: pa.NativeFile, entry: tuple[int, int, int]) -> bytes:
    at, packed, plain = entry
    return zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=plain)


def _writer(folder: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        bundle, rows = None, []

        def finished() -> pa.RecordBatch:
            bundle.close()
            columns = zip(*rows, strict=True)
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["bundle", "record_id", "page_id", "frame", "offset", "length"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None:
                    # A name of its own for every attempt: what a lost attempt wrote is in no index.
                    bundle, rows = Bundle(store, f"{base}/{uuid.uuid4().hex}.warc.zst"), []
                place = bundle.add(render(row))
                name = f"{folder}/{bundle.path.rsplit('/', 1)[1]}"
                rows.append((name, record_id(row["page_id"]), row["page_id"], *place))
                if bundle.written >= BUNDLE_BYTES:
                    yield finished()
                    bundle = None
        if bundle is not None:
            yield finished()

    return run


def write_bundles(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write a record per page and return the index: ``bundle, record_id, page_id, frame, offset, length``.

    Records are grouped into frames that decompress on their own; a bundle ends with a
    seek table of its frames, in the public seekable format, so any reader of that or of
    plain Zstandard can use it. ``offset`` and ``length`` are within the uncompressed frame.
    Tasks write bundles straight to the shared folder. A bundle of a failed attempt is in
    no index and does no harm.

    Of pages with one payload of at least REVISIT_BYTES the smallest page id is the response and
    the others are revisits. Only digests are shuffled for this, never payloads, while the
    digests that repeat are few enough to be broadcast after a count.

    Defined cases: NULL html is an empty payload; NULL urls are empty; pages that repeat the
    smallest id of their payload are responses as well; pages with a NULL id are revisits if another
    page has their payload and an id, else responses; extra columns are ignored; an empty
    table gives an empty index.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("n"),
    )
    repeated = (
        rows.filter(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 and first is not null")
        .select("digest", "first")
    )
    known = broadcast_if_small(stage(repeated, "warc-repeated"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(known, "digest", "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "digest",
        "n",
        revisit.alias("revisit"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )
    return stage(marked.mapInArrow(_writer(folder), INDEX), "warc-index")


def _record_row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not match its digest")
    refers = headers.get("WARC-Refers-To")
    return {
        "page_id": page_of(headers["WARC-Record-ID"]),
        "payload_bytes": len(block) if kind == "response" else int(headers["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(refers) if refers else None,
        "url": headers["WARC-Target-URI"],
        "payload": block if with_payload and kind == "response" else None,
    }


_ROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _reader(with_payload: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                store, inner = open_store(path)
                with store.open_input_file(inner) as file:
                    for entry in seek_table(file):
                        data, at, rows = _frame(file, entry), 0, []
                        while at < len(data):
                            headers, block, at = parse(data, at)
                            rows.append(_record_row(headers, block, with_payload))
                        yield pa.RecordBatch.from_pylist(rows, schema=_ROW)

    return run


def read_bundles(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that an index names, read frame by frame; the payload of
    each response is checked against its digest. Bundles are dealt out one to a task, up
    to MOST_READERS tasks: the list of names is short, and would else be one task's.

    An empty index gives no records; a bundle without records gives none."""
    bundles = index.select("bundle").distinct()
    return bundles.repartition(_readers(index)).mapInArrow(_reader(with_payload), RECORDS)


def _readers(index: DataFrame) -> int:
    bundles = index.agg(F.count_distinct("bundle")).first()[0]
    return max(1, min(bundles, MOST_READERS))


def _seeker() -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            wanted: dict[str, list[dict]] = {}
            for row in batch.to_pylist():
                wanted.setdefault(row["bundle"], []).append(row)
            for path, rows in wanted.items():
                store, inner = open_store(path)
                with store.open_input_file(inner) as file:
                    table, frame, data = seek_table(file), -1, b""
                    for row in sorted(rows, key=lambda r: (r["frame"], r["offset"])):
                        if row["frame"] != frame:
                            frame = row["frame"]
                            data = _frame(file, table[frame])
                        headers, block, _ = parse(data, row["offset"])
                        yield pa.RecordBatch.from_pylist(
                            [_record_row(headers, block, True)], schema=_ROW
                        )

    return run


def fetch(index_rows: DataFrame) -> DataFrame:
    """The records of some index rows: each is read by seeking to its frame, and a frame
    that holds several of them is decompressed once per batch. No rows give no records."""
    wanted = index_rows.select("bundle", "frame", "offset")
    placed = wanted.repartition(_readers(wanted), "bundle")
    return placed.mapInArrow(_seeker(), RECORDS)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to a new folder of bundles and read them back; an empty table gives
    no bundles and no records."""
    index = write_bundles(pages, new_path(spark, "warc"))
    return read_bundles(index, with_payload=False)
