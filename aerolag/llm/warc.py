"""WARC archives: writing with revisit records, and a reader that salvages damaged files.

The reader walks an archive record by record. A record is good if its version line, headers, lengths,
closing line breaks and digest hold. After a failed check the reader searches on for the next member or
version line that starts a good record, goes on from there, and logs the bytes between as quarantined.
A gzip member is searched the same way in what it inflates to, and a damaged one as far as it inflates.
"""

from __future__ import annotations

import hashlib
import re
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from aerolag.llm.tables import map_arrow, small_side
from aerolag.storage import scratch_path, stage

MIN_REVISIT_BYTES = 1000
#: Largest payload of a class of pages, and records in a file of that class: some 64 MB of either. Pages above all
#: classes have a file each.
FILE_CLASSES = ((16 * 1024, 4000), (256 * 1024, 256), (4 * 1024 * 1024, 16))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
#: Compressed bytes inflated at a time.
CHUNK = 64 * 1024
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(_VERSION.pattern + b"|" + MAGIC)


@dataclass(frozen=True)
class Gap:
    """Bytes no good record covers; those inside a gzip member are named by the reason, at the member's offset."""

    offset: int
    length: int
    reason: str


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


class Damaged(ValueError):
    pass


def _parse(data: bytes, at: int) -> Record:
    """The plain record that starts at ``at``, or ``Damaged``."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    end = data.find(END, at)
    if end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for line in data[version.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        raise Damaged("no content length")
    start = end + len(END)
    payload = data[start : start + int(size)]
    if len(payload) != int(size) or data[start + int(size) : start + int(size) + 4] != END:
        raise Damaged("record is cut or has a wrong length")
    digest = headers.get("warc-block-digest")
    if digest and digest != "sha1:" + hashlib.sha1(payload).hexdigest():
        raise Damaged("digest differs")
    return Record(at, start + int(size) + 4 - at, headers, payload)


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` inflates to, its compressed length, and what is wrong with it."""
    inflate, view, place, parts = zlib.decompressobj(31), memoryview(data), at, []
    while place < len(data) and not inflate.eof:
        before = inflate.copy()
        try:
            parts.append(inflate.decompress(view[place : place + CHUNK]))
        except zlib.error:
            # Up to the byte that does not inflate.
            for byte in range(place, min(place + CHUNK, len(data))):
                try:
                    parts.append(before.decompress(view[byte : byte + 1]))
                except zlib.error:
                    break
            return b"".join(parts), 0, "gzip member is damaged"
        place = min(place + CHUNK, len(data))
    return b"".join(parts), place - len(inflate.unused_data) - at, "" if inflate.eof else "gzip member is cut"


def _consumed(data: bytes, at: int, size: int) -> int:
    """How many bytes of the gzip member at ``at`` inflate to its first ``size``."""
    inflate, view, place, done = zlib.decompressobj(31), memoryview(data), at, 0
    while True:
        before = inflate.copy()
        try:
            more = len(inflate.decompress(view[place : place + CHUNK]))
        except zlib.error:
            break
        if done + more >= size:
            break
        done, place = done + more, place + CHUNK
    while done < size:
        done += len(before.decompress(view[place : place + 1]))
        place += 1
    return place - at


def _plain_pieces(data: bytes) -> Iterator[Record | Gap]:
    """The good records of plain bytes in order, and the gaps between them."""
    at, bad_from, reason = 0, None, ""
    while at < len(data):
        try:
            record = _parse(data, at)
        except Damaged as error:
            if bad_from is None:
                bad_from, reason = at, str(error)
            later = _VERSION.search(data, at + 1)
            at = later.start() if later else len(data)
            continue
        if bad_from is not None:
            yield Gap(bad_from, at - bad_from, reason)
            bad_from = None
        yield record
        at += record.length
    if bad_from is not None:
        yield Gap(bad_from, len(data) - bad_from, reason)


def _pieces_at(data: bytes, at: int) -> tuple[list[Record | Gap], int, str]:
    """The good records and gaps of the member or the one plain record at ``at``, where they end, and what is wrong there."""
    if not data.startswith(MAGIC, at):
        record = _parse(data, at)
        return [record], at + record.length, ""
    plain, length, wrong = _inflate(data, at)
    pieces = list(_plain_pieces(plain))
    if not any(isinstance(piece, Record) for piece in pieces):
        raise Damaged(wrong or (pieces[0].reason if pieces else "empty gzip member"))
    if wrong:
        # What follows the last good record is searched again, as another member may begin there.
        if isinstance(pieces[-1], Gap):
            pieces.pop()
        length = _consumed(data, at, pieces[-1].offset + pieces[-1].length)
    found: list[Record | Gap] = []
    for piece in pieces:
        if isinstance(piece, Gap):
            found.append(Gap(at, length, f"{piece.reason} (inflated bytes {piece.offset} to {piece.offset + piece.length})"))
        else:
            found.append(Record(at, length, piece.headers, piece.payload))
    return found, at + length, f"{wrong} (member at {at})" if wrong else ""


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All good records of an archive in order, and the gaps between them."""
    at, bad_from, reason = 0, None, ""
    while at < len(data):
        try:
            found, end, wrong = _pieces_at(data, at)
        except Damaged as error:
            if bad_from is None:
                bad_from, reason = at, str(error)
            later = _START.search(data, at + 1)
            at = later.start() if later else len(data)
            continue
        if bad_from is not None:
            yield Gap(bad_from, at - bad_from, reason)
            bad_from = None
        yield from found
        at = end
        if wrong:
            bad_from, reason = at, wrong
            later = _START.search(data, at)
            at = later.start() if later else len(data)
    if bad_from is not None:
        yield Gap(bad_from, len(data) - bad_from, reason)


def _header_value(column: Column) -> Column:
    """One line of text: line breaks and other control characters become blanks."""
    return F.trim(F.regexp_replace(column, r"[\x00-\x1F\x7F]", " "))


def archive_rows(pages: DataFrame) -> DataFrame:
    """Every page with its record: page_id, url, type, refers_to, payload size and SHA-1, and the text of the record.

    Pages with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes: the one with the largest
    page_id is the response, the others revisit it; rows that share that page_id are responses all.
    A null html is an empty payload. A null page_id never outranks another one.
    """
    plain = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    large = F.col("bytes") >= MIN_REVISIT_BYTES
    first = plain.filter(large).groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies"))
    first = stage(first.filter("copies > 1").select("digest", "original"), "copied-payloads")
    # Broadcast where small, as measured: then no html is shuffled.
    rows = plain.join(small_side(first, "digest"), "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")) & large
    rows = rows.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("original"))})
    return rows.drop("original")


def _record_text() -> Column:
    """The record as text without its last line break, which the text writer adds."""
    line = F.lit("\r\n")
    size = F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(0)
    block = F.when(F.col("record_type") == "response", F.col("html")).otherwise("")
    block_digest = F.when(F.col("record_type") == "response", F.col("digest")).otherwise(hashlib.sha1(b"").hexdigest())

    def header(name: str, value: Column) -> Column:
        return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), line))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", _header_value(F.col("url"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Block-Digest", F.concat(F.lit("sha1:"), block_digest)),
        header("WARC-Profile", F.when(F.col("record_type") == "revisit", PROFILE)),
        header("X-Page-Id", F.col("page_id")),
        header("X-Payload-Length", F.col("bytes")),
        header("X-Refers-To-Page-Id", F.col("refers_to")),
        header("Content-Type", F.lit("text/html; charset=utf-8")),
        header("Content-Length", size),
        line,
        block,
        F.lit("\r\n\r"),
    )


def write_archives(pages: DataFrame, path: str, classes: tuple[tuple[int, int], ...] = FILE_CLASSES) -> None:
    """Write ``pages`` as WARC files below ``path``, on any file system Spark can write.

    ``classes`` are (largest payload in bytes, records in a file), ascending: files are bounded in bytes, so that one
    can be read as a whole. One pass over the pages for each class they fill.
    """
    rows = archive_rows(pages)
    number = F.lit(len(classes))
    for i, (most, _) in reversed(list(enumerate(classes))):
        number = F.when(F.col("bytes") <= most, i).otherwise(number)
    sizes = pages.select(F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0)).alias("bytes"))
    filled = sorted(row["class"] for row in sizes.select(number.alias("class")).distinct().collect())
    for i in filled or [0]:
        records = classes[i][1] if i < len(classes) else 1
        chosen = rows if len(filled) <= 1 else rows.filter(number == i)
        chosen = chosen.select(_record_text().alias("value"))
        chosen.write.option("maxRecordsPerFile", records).option("lineSep", "\n").text(f"{path}/class-{i}")


def read_archives(df: DataFrame) -> DataFrame:
    """Good records and quarantined gaps of archives given as rows (path, content).

    Each row: path, offset, length, gap (reason, null for records), record headers and payload.
    An empty archive gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string()),
            ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ])
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or b""
                rows, held = [], 0
                for found in salvage(data):
                    gap = found.reason if isinstance(found, Gap) else None
                    headers = [] if gap else list(found.headers.items())
                    payload = None if gap else found.payload
                    rows.append((path, found.offset, found.length, gap, headers, payload))
                    held += len(payload or b"") + 500
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    return map_arrow(
        df.select("path", "content"), read, "path string, offset long, length long, gap string, headers map<string,string>, payload binary"
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are those of the payload read; a revisit names its payload's. An
    empty table gives no rows. Bytes that no good record covers are written down beside the archives (``-gaps``),
    with a warning that names the table.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_pages(pages.sparkSession, path, pages.schema["page_id"].dataType)


def read_pages(spark: SparkSession, path: str, id_type: DataType) -> DataFrame:
    """The pages of the archives that ``write_archives`` wrote below ``path``, as ``archive_round_trip`` returns them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    records = read_archives(files.load(path))
    head, response = (lambda name: F.col("headers").getItem(name)), F.col("headers").getItem("warc-type") == "response"
    read = records.select(
        F.col("path").alias("file"),
        "offset",
        "length",
        "gap",
        head("x-page-id").cast(id_type).alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(head("x-payload-length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.substring(head("warc-payload-digest"), 6, 40)).alias("payload_digest"),
        head("warc-type").alias("record_type"),
        head("x-refers-to-page-id").cast(id_type).alias("refers_to"),
    )
    found = stage(read, "warc-read")
    gaps = found.filter("gap IS NOT NULL").select("file", "offset", "length", "gap")
    lost = gaps.agg(F.count("*"), F.sum("length")).first()
    if lost[0]:
        gaps.write.mode("overwrite").parquet(f"{path}-gaps")
        warnings.warn(f"{lost[0]} gaps of {lost[1]} bytes quarantined, listed in {path}-gaps", stacklevel=2)
    return found.filter("gap IS NULL").drop("file", "offset", "length", "gap")
