"""WARC archives: a writer with revisit records, and a reader that salvages what it can of damaged files.

Writing: of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the least id is a response and
the others are revisits that refer to it, without the payload. Digests and their least ids are found by Spark; each
task then writes archives of about ``ARCHIVE_BYTES`` with one gzip member for each record, under names made from the
task, so that a task that runs again replaces its own files.

Reading: a file is read member by member with bounded memory per record. Where a member does not inflate, its record
does not parse, or its digest is wrong, the reader searches for the next gzip member that begins with a version line,
or in an uncompressed file for the next version line, goes on there, and reports the bytes between as a gap. So one bad
record costs that record. A file that breaks off ends with a gap.

Null ids are written with an empty id and read back as null. A null payload is empty. A null address becomes an empty
header. Repeated rows become one record each; if rows with the least id have equal payloads, each of them is a response.
An empty table gives no archives and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
VERSION = b"WARC/1.1"
EARLIEST = b"WARC/1."
MEMBER = b"\x1f\x8b\x08"
MOST_HEADER = 1 << 20
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = str.maketrans({"\r": "%0D", "\n": "%0A"})


# --- writing ---


def record_bytes(kind: str, page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    """One uncompressed record. The full payload's digest and size are in the header, also of a revisit."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    lines = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').translate(_UNSAFE)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        task, count, out, size, records = TaskContext.get().partitionId(), 0, None, 0, 0
        done: list[tuple[str, int, int]] = []
        path = ""
        for batch in batches:
            for page_id, url, html, digest, n_bytes, refers_to in zip(*[batch.column(i) for i in range(6)], strict=True):
                page_id, refers_to, text = page_id.as_py(), refers_to.as_py(), html.as_py() or ""
                kind = "response" if refers_to is None else "revisit"
                payload = text.encode() if kind == "response" else b""
                data = _member(record_bytes(kind, page_id, url.as_py(), digest.as_py(), n_bytes.as_py(), refers_to, payload))
                if out is None:
                    path = f"{root}/part-{task:06d}-{count:06d}.warc.gz"
                    out, size, records = files.open_output_stream(path), 0, 0
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, size, records))
                    out, count = None, count + 1
        if out is not None:
            out.close()
            done.append((path, size, records))
        yield pa.record_batch([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    import pyarrow.fs  # noqa: F401  the tasks need it as pa.fs

    return run


def with_digests(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with the digest and size of the payload and, for revisits, the id of the response."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), F.sha2(payload, 256).alias("digest"), F.length(payload).cast("long").alias("n_bytes"))
    # Only digests are shuffled to find the first of each; texts go to a join with the few that repeat.
    first = rows.where(f"n_bytes >= {int(least)}").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(first, "digest", "left")
    return rows.withColumn("refers_to", F.expr("IF(first_id <> page_id OR (first_id IS NOT NULL AND page_id IS NULL), first_id, NULL)"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below ``folder`` (a URI all executors reach) and returns ``(path, bytes, records)`` of each.

    The result is computed here once; reading it does not write again.
    """
    rows = with_digests(pages, id_col, url_col, html_col, least)
    written = rows.select("page_id", "url", "html", "digest", "n_bytes", "refers_to").mapInArrow(_writer(_uri(folder), archive_bytes), "path string, bytes long, records long")
    manifest = f"{folder.rstrip('/')}/manifest"
    written.write.parquet(manifest)
    return pages.sparkSession.read.schema("path string, bytes long, records long").parquet(manifest)


def _uri(folder: str) -> str:
    """A URI with a scheme, for the file systems of the tasks."""
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


# --- reading ---


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    payload: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class _Window:
    """A file read forward with a buffer that grows to one record at most and forgets what was used."""

    def __init__(self, source: BinaryIO):
        self.source, self.data, self.base, self.ended = source, b"", 0, False

    def more(self) -> bool:
        got = b"" if self.ended else self.source.read(CHUNK)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.base = self.data[n:], self.base + n


def parse_record(data: bytes) -> tuple[dict[str, str], int, int]:
    """Headers, and where the payload begins and ends; ``IndexError`` if more bytes are needed."""
    if not data.startswith(EARLIEST):
        if EARLIEST.startswith(data[: len(EARLIEST)]):
            raise IndexError
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", 0, MOST_HEADER)
    if end < 0:
        if len(data) >= MOST_HEADER:
            raise ValueError("header does not end")
        raise IndexError
    headers = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("bad header line")
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise ValueError("no content length")
    begin = end + 4
    return headers, begin, begin + int(size)


def checked(headers: dict[str, str], payload: bytes) -> None:
    """Raises ``ValueError`` unless a response has the payload its header names."""
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest[7:]:
        raise ValueError("digest differs")


def _plain_record(window: _Window) -> tuple[Record, int]:
    while True:
        try:
            headers, begin, end = parse_record(window.data)
            # A wrong length must not swallow the rest of the file unseen: the end mark has to follow.
            if len(window.data) >= end + 4:
                break
        except IndexError:
            pass
        if not window.more():
            raise ValueError("file ends inside a record")
    if window.data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("no end mark")
    payload = window.data[begin:end]
    checked(headers, payload)
    return Record(window.base, headers, payload), end + 4


def _packed_record(window: _Window) -> tuple[Record, int]:
    """Inflates the member at the head of the window, giving each byte to the decompressor once."""
    unpack = zlib.decompressobj(31)
    parts, at = [], 0
    while not unpack.eof:
        if at == len(window.data) and not window.more():
            raise ValueError("file ends inside a member")
        try:
            parts.append(unpack.decompress(window.data[at : at + CHUNK]))
        except zlib.error as e:
            raise ValueError(f"member does not inflate: {e}") from None
        at = min(len(window.data), at + CHUNK)
    used = at - len(unpack.unused_data)
    data = b"".join(parts)
    try:
        headers, begin, end = parse_record(data)
    except IndexError:
        raise ValueError("record breaks off") from None
    if data[end:] != b"\r\n\r\n":
        raise ValueError("no end mark")
    checked(headers, data[begin:end])
    return Record(window.base, headers, data[begin:end]), used


def _begins_record(window: _Window, at: int) -> bool:
    """Whether a gzip member at this place inflates to a version line."""
    while len(window.data) < at + 512 and window.more():
        pass
    try:
        head = zlib.decompressobj(31).decompress(window.data[at : at + 512], len(EARLIEST))
    except zlib.error:
        return False
    return head == EARLIEST


def _search(window: _Window, packed: bool) -> bool:
    """Moves the window to the next place after its head where a record may begin; false if there is none."""
    mark, at = (MEMBER if packed else EARLIEST), 1
    while True:
        found = window.data.find(mark, at)
        if found >= 0:
            if not packed or _begins_record(window, found):
                window.drop(found)
                return True
            at = found + 1
            continue
        # The mark may lie across the edge of what has been read.
        keep = max(1, len(window.data) - len(mark) + 1)
        window.drop(keep - 1)
        at = 1
        if not window.more():
            window.drop(len(window.data))
            return False


def salvage(source: BinaryIO) -> Iterator[Record | Gap]:
    """All records that pass their checks, and the gaps between them, in file order."""
    window = _Window(source)
    gap: tuple[int, str] | None = None
    while window.data or window.more():
        while len(window.data) < 8 and window.more():
            pass
        packed = window.data.startswith(MEMBER)
        start = window.base
        try:
            record, used = (_packed_record if packed else _plain_record)(window)
        except ValueError as e:
            gap = gap or (start, str(e))
            # After damage either kind of record may follow; the kind the file has is told by what is found first.
            if not _search_any(window):
                break
            continue
        if gap:
            yield Gap(gap[0], record.offset - gap[0], gap[1])
            gap = None
        yield record
        window.drop(used)
    if gap:
        yield Gap(gap[0], window.base - gap[0], gap[1])


def _search_any(window: _Window) -> bool:
    """The next gzip member with a version line, or the next version line, whichever is first."""
    at = 1
    longest = max(len(MEMBER), len(EARLIEST))
    while True:
        places = [p for p in (window.data.find(MEMBER, at), window.data.find(EARLIEST, at)) if p >= 0]
        if places:
            place = min(places)
            if window.data.startswith(EARLIEST, place) or _begins_record(window, place):
                window.drop(place)
                return True
            at = place + 1
            continue
        if len(window.data) > longest:
            window.drop(len(window.data) - longest)
            at = 1
        if not window.more():
            window.drop(len(window.data))
            return False


_ROW = "path string, offset long, gap_bytes long, reason string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _number(text: str | None) -> int | None:
    text = text or ""
    return int(text) if text.removeprefix("-").isdigit() else None


def _reader(root: str, with_payload: bool):
    import pyarrow.fs  # noqa: F401

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pa.fs.FileSystem.from_uri(root)
        names = [x.split()[0] for x in _ROW.split(", ")] + ["payload"] * with_payload
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path) as source:
                    for x in salvage(source):
                        if isinstance(x, Gap):
                            row = (path, x.offset, x.length, x.reason, None, None, None, None, None, None, None)
                        else:
                            h = x.headers
                            row = (path, x.offset, None, None, _number(h.get("x-page-id")), h.get("warc-target-uri"), h.get("warc-type"), _number(h.get("x-payload-length")), h.get("warc-payload-digest", "").removeprefix("sha256:"), _number(h.get("x-refers-to-page-id")), x.payload)
                            held += len(x.payload) * with_payload
                        rows.append(row)
                        if len(rows) == 4096 or held > 4 << 20:
                            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each record or gap of the archives ``(path, ...)``; a gap has ``gap_bytes`` and a reason."""
    tasks = max(1, spark.sparkContext.defaultParallelism)
    spread = archives.select("path").repartition(tasks, "path")
    return spread.mapInArrow(_reader(_uri(folder), with_payload), _ROW + ", payload binary" * with_payload)
