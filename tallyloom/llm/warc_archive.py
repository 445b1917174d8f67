"""WARC archives of Zstandard frames with a dictionary in front."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import scratch

# Fixed values of the file formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An empty skippable frame in plain characters; it stands after each record, where a
# text writer puts its line end.
GAP = "P*M\x18\0\0\0\0"
# Bytes of payload in an archive, and of those that its dictionary is made from.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 8 << 20, 1 << 20, 32 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    revisit = refers_to is not None
    kind = "revisit" if revisit else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    clean = "".join(c for c in url if c >= " " and c != "\x7f")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", clean),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, threads=0)
    except zstandard.ZstdError:  # too few or too small samples
        return None


def _archive(records: list[bytes]) -> Iterator[bytes]:
    sample, size = [], 0
    for record in records:
        if size > SAMPLE_BYTES:
            break
        sample.append(record[:DICTIONARY_BYTES])
        size += len(sample[-1])
    trained = _dictionary(sample) if len(sample) >= 16 else None
    held = trained.as_bytes() if trained else b""
    yield DICTIONARY_MAGIC.to_bytes(4, "little") + len(held).to_bytes(4, "little") + held
    writer = zstandard.ZstdCompressor(dict_data=trained, write_content_size=True, write_checksum=True)
    for record in records:
        yield writer.compress(record)


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frames of the archives of one task, in writing order, each archive numbered."""
    number, waiting, size = 0, [], 0

    def flush() -> pa.RecordBatch:
        rows = list(_archive(waiting))
        columns = [pa.array([number] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())]
        return pa.record_batch(columns, ["archive", "place", "frame"])

    for batch in batches:
        for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
            payload = (html.as_py() or "").encode()
            waiting.append(_record(page_id.as_py(), url.as_py() or "", payload, refers_to.as_py()))
            size += len(payload)
            if size >= ARCHIVE_BYTES:
                yield flush()
                number, waiting, size = number + 1, [], 0
    if waiting:
        yield flush()


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``refers_to``: the id whose record holds the same payload.

    Of pages with equal payloads of at least ``least_bytes`` bytes the largest id
    keeps the payload; all others refer to it. Pages without an id refer to it
    too, and keep their payload where no page has an id.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    holders = rows.groupBy("sha").agg(F.max("page_id").alias("holder"))
    bound = F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes
    other = bound & F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return rows.join(holders, "sha").select("page_id", "url", "html", F.when(other, F.col("holder")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``(page_id, url, html)`` as ``*.warc.zst`` content below ``path``.

    One record per row: a response, or a revisit of the page with the same
    payload. Each archive holds about 8 MB of payload and starts with a skippable
    frame that carries its dictionary; an archive too small to train one carries
    an empty dictionary. Spark's own writer commits the files, so lost tasks
    leave nothing behind. Null texts are empty payloads.
    """
    frames = with_revisits(pages, least_bytes).mapInArrow(_frames, "archive int, place int, frame binary")
    (
        frames.sortWithinPartitions("archive", "place")  # the writer then need not sort, and keeps this order
        .select("archive", F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", GAP)
        .partitionBy("archive")
        .text(path)
    )


class BrokenArchive(ValueError):
    """An archive or record that breaks the format."""


def archive_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive; raises BrokenArchive."""
    view, at, reader = memoryview(content), 0, None
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if at + 8 + size > len(view):
                raise BrokenArchive("a skippable frame is cut off")
            if at == 0:
                if magic != DICTIONARY_MAGIC:
                    raise BrokenArchive("the archive does not start with a dictionary frame")
                held = bytes(view[8 : 8 + size])
                if held[:4] == FRAME_MAGIC.to_bytes(4, "little"):
                    held = zstandard.ZstdDecompressor().decompress(held)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held) if held else None)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC or reader is None:
            raise BrokenArchive(f"no frame at byte {at}")
        frame = reader.decompressobj()
        try:
            record = frame.decompress(view[at:])
        except zstandard.ZstdError as error:
            raise BrokenArchive(f"bad frame at byte {at}: {error}") from error
        if not frame.eof:
            raise BrokenArchive("a frame is cut off")
        at = len(view) - len(frame.unused_data)
        yield _parsed(record)


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise BrokenArchive("a record has no version line or header end")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon or name in fields:
            raise BrokenArchive(f"bad header line {line!r}")
        fields[name] = value
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
        if name not in fields:
            raise BrokenArchive(f"a record has no {name}")
    size = fields["Content-Length"]
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BrokenArchive("a record is not as long as its header says")
    block = rest[:-4]
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise BrokenArchive("a block does not match its digest")
    return fields, block


def _page(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _rows(content: bytes) -> Iterator[dict]:
    for fields, block in archive_records(content):
        head, mark, payload = block.partition(b"\r\n\r\n")
        sizes = [line.partition(b":")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        if not mark or len(sizes) != 1 or not sizes[0].strip().isdigit():
            raise BrokenArchive("a block has no HTTP header with one length")
        size, digest, kind = int(sizes[0]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        if kind == "response" and (size != len(payload) or payload_digest(payload) != digest):
            raise BrokenArchive("a payload does not match its length or digest")
        if kind not in ("response", "revisit") or kind == "revisit" and payload:
            raise BrokenArchive(f"bad record of type {kind}")
        yield {
            "page_id": _page(fields["WARC-Record-ID"]),
            "url": fields["WARC-Target-URI"],
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None,
        }


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _reader(payloads: bool):
    names, kinds = (NAMES, KINDS) if payloads else (NAMES[:-1], KINDS[:-1])
    schema = pa.schema(list(zip(names, kinds)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                waiting = []
                for row in _rows(content.as_py()):
                    waiting.append({n: row[n] for n in names})
                    if len(waiting) == 256:
                        yield pa.RecordBatch.from_pylist(waiting, schema)
                        waiting = []
                yield pa.RecordBatch.from_pylist(waiting, schema)

    return read


def read_archives(spark, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives below ``path``, one task per few archives.

    The dictionary comes from each archive's leading skippable frame; every
    record is one frame. Frame ends, header lines, lengths and digests are
    checked, and a fault stops the job. Revisits carry the size and digest of the
    payload they refer to. With ``payloads`` the bytes are returned too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_reader(payloads), RECORD + (", payload binary" if payloads else ""))


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read their records back."""
    spark = pages.sparkSession
    path = scratch(spark, "archives")
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path)
