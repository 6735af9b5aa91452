"""WARC archives in seekable Zstandard bundles.

Every page is one WARC record. Records are gathered into frames of about
``frame_bytes``, each compressed on its own; frames follow one another in a bundle, which
ends with a seek table (a skippable frame listing the compressed and plain size of each
frame), so any frame can be found from the end of the file and read alone. The
index maps each record identifier to its bundle, frame and offset in the plain frame.

Of records with equal payloads of at least ``min_payload`` bytes the one with the smallest
id is a ``response``, the others are ``revisit`` records that refer to it. Only the digests of
payloads that occur more than once are joined; a very frequent payload is one row of
that join's small side.

Tasks write under names of their own attempt; only bundles that the index of finished
tasks names are ever read, so a lost or repeated task leaves unused files, not wrong
ones. Files go to the shared scratch folder through ``pyarrow.fs``, whatever store it is in.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import slices, stage

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


def file_system(path: str):
    """(file system, path in it) of a folder named by URI or plain local path."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and "://" not in path else path)
    return fs.LocalFileSystem(), path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _line(value: str) -> str:
    """A header value: line ends would end the header."""
    return " ".join(value.splitlines()) if value else ""


def make_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    if refers_to is not None:
        # the block of a revisit is the HTTP header, which keeps the payload's length
        head += [f"WARC-Refers-To: <{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> dict:
    """Headers (lower-cased names), payload and its full length, of the record at an offset."""
    def headers(start: int) -> tuple[dict[str, str], int]:
        end = data.index(b"\r\n\r\n", start)
        lines = data[start:end].decode("utf-8").split("\r\n")
        return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}, end + 4

    if data[at:at + 8] != b"WARC/1.1":
        raise ValueError(f"no record at {at}")
    warc, body = headers(at)
    http, payload = headers(body)
    end = body + int(warc["content-length"])
    return {"warc": warc, "payload": data[payload:end], "length": int(http["content-length"])}


class BundleWriter:
    def __init__(self, system, path: str, frame_bytes: int, level: int):
        self.out, self.path = system.open_output_stream(path, compression=None), path
        self.frame_bytes, self.zstd = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.parts: list[bytes] = []
        self.plain = self.written = 0
        self.table: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the plain frame) of the record."""
        if self.plain and self.plain + len(record) > self.frame_bytes:
            self._frame()
        at = len(self.table), self.plain
        self.parts.append(record)
        self.plain += len(record)
        return at

    def _frame(self) -> None:
        packed = self.zstd.compress(b"".join(self.parts))
        self.out.write(packed)
        self.table.append((len(packed), self.plain))
        self.written += len(packed)
        self.parts, self.plain = [], 0

    def close(self) -> None:
        if self.plain:
            self._frame()
        body = b"".join(struct.pack("<II", c, d) for c, d in self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class BundleReader:
    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * count)
        table = struct.iter_unpack("<II", self.file.read(8 * count))
        self.frames, at = [], 0
        for packed, plain in table:
            self.frames.append((at, packed, plain))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, n: int) -> bytes:
        at, packed, plain = self.frames[n]
        self.file.seek(at)
        return self.zstd.decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def referrals(pages: DataFrame, id_col: str, html_col: str, min_payload: int) -> DataFrame:
    """``pages`` with ``__refers`` (the response's id where the row is a revisit, else null)
    and ``__revisit``."""
    digest = F.sha1(F.coalesce(F.col(html_col), F.lit("")))
    size = F.octet_length(F.coalesce(F.col(html_col), F.lit("")))
    first = (pages.filter(size >= min_payload).select(digest.alias("__digest"), F.col(id_col).alias("__i")).groupBy("__digest")
             .agg(F.min("__i").alias("__first"), F.count("*").alias("__n")).filter(F.col("__n") > 1).drop("__n"))
    joined = pages.withColumn("__digest", digest).join(first, "__digest", "left")
    revisit = F.col("__first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("__first"))
    return joined.withColumn("__refers", F.when(revisit, F.col("__first"))).withColumn("__revisit", revisit).drop("__digest", "__first")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_payload: int = 0, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28, level: int = 3,
                   date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write the pages and return the index: id, ``record_id``, ``bundle``, ``frame``, ``offset``.

    A null html is an empty payload, a null url has no target header. Rows that repeat
    the smallest id of a payload are responses each; a null id is larger than any other and
    refers to the smallest id, or, if all ids are null, every copy is a response. An
    empty table writes nothing. Other columns are ignored. The result must be written
    before it is used twice: computing it writes the archives.
    """
    src = referrals(pages.select(id_col, url_col, html_col), id_col, html_col, min_payload).select(id_col, url_col, html_col, "__refers", "__revisit")
    schema = T.StructType([pages.schema[id_col], T.StructField("record_id", T.StringType()), T.StructField("bundle", T.StringType()),
                           T.StructField("frame", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        bundle, number, serial = None, 0, 0
        for batch in batches:
            ids, records, bundles, frames, offsets = [], [], [], [], []
            for pages_, urls, htmls, refers, revisits in slices([batch], 2):
                for page, url, html, refer, revisit in zip(pages_, urls, htmls, refers, revisits):
                    if bundle is None:
                        bundle = BundleWriter(system, f"{root}/{name}-{number}.warc.zst", frame_bytes, level)
                    record_id = f"urn:page:{page}:{name}:{serial}"
                    serial += 1
                    frame, offset = bundle.add(make_record(record_id, url, (html or "").encode("utf-8", "replace"),
                                                           f"urn:page:{refer}" if revisit else None, date))
                    for c, v in zip((ids, records, bundles, frames, offsets),
                                    (page, record_id, f"{name}-{number}.warc.zst", frame, offset)):
                        c.append(v)
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle, number = None, number + 1
            types = [batch.schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, records, bundles, frames, offsets), types)],
                                             names=schema.names)
        if bundle is not None:
            bundle.close()

    return src.mapInArrow(run, schema)


def read_archives(index: DataFrame, folder: str, id_col: str = "page_id") -> DataFrame:
    """The records an index names, read by frame: id, ``payload_bytes`` and
    ``payload_digest`` (of the full payload), ``record_type``, ``refers_to`` (the text of the
    id), ``url``, ``payload`` (binary; empty for revisits). Raises if an offset holds another
    record than the index says or a response's digest is wrong."""
    schema = T.StructType([index.schema[id_col], T.StructField("payload_bytes", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in ("payload_digest", "record_type", "refers_to", "url")]
                          + [T.StructField("payload", T.BinaryType())])

    def run(batches):
        system, root = file_system(folder)
        reader, open_name, frame_no, data = None, None, None, b""
        rows: list[tuple] = []
        kind, held = None, 0

        def emit():
            types = [kind, pa.int64()] + [pa.string()] * 4 + [pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)
            rows.clear()
            return out

        for batch in batches:
            kind = batch.schema.field(0).type
            for page, record_id, bundle, frame, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != open_name:
                    if reader:
                        reader.close()
                    reader, open_name, frame_no = BundleReader(system, f"{root}/{bundle}"), bundle, None
                if frame != frame_no:
                    data, frame_no = reader.frame(frame), frame
                r = parse_record(data, offset)
                h = r["warc"]
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-record-id"] != f"<{record_id}>" or h["warc-type"] == "response" and payload_digest(r["payload"]) != digest:
                    raise ValueError(f"{bundle}, frame {frame}, offset {offset}: not the record {record_id}")
                refers = h.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None
                rows.append((page, r["length"], digest, h["warc-type"], refers, h.get("warc-target-uri"), r["payload"]))
                held += len(r["payload"])
                if held >= 8 << 20:
                    yield emit()
                    held = 0
        if rows:
            yield emit()

    return (index.select(id_col, "record_id", "bundle", "frame", "offset").repartition("bundle")
            .sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, schema))


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", **options) -> DataFrame:
    """Write the pages, keep the index in shared scratch, and read every record back."""
    return read_archives(stage(write_archives(pages, folder, id_col, **options), "warc-index"), folder, id_col)
