"""Web archives: WARC files of one gzip member for each record, written and read in parallel.

Files are read in byte ranges. A task looks for the gzip magic in its range and
takes a place as the start of a record only if what it finds there decodes to a WARC
header; from then on each record begins where the one before ended. A task
owns the records that start inside its range, and reads the last one to its end.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.llm.tables import ship_package
from clearbook.sources.sinks import staged

# Fixed values of the formats: gzip's magic with the only compression method, and the marks of a WARC record.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
HEAD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = (
    "file string, offset long, stop long, range_start long, record_type string, record_id string, uri string, "
    "refers_to string, digest string, payload_bytes long, payload binary"
)
# Bytes read from a file at a time.
STEP = 1 << 20


def base32_digest(payload: Column) -> Column:
    """SHA-1 of a binary column as upper-case base32: 160 bits in groups of five."""
    hexed = F.sha1(payload)
    groups = [F.conv(F.substring(hexed, 1 + 5 * k, 5), 16, 10).cast("int") for k in range(8)]
    letters = [F.substring(F.lit(BASE32), F.shiftright(g, bits).bitwiseAND(31) + 1, F.lit(1)) for g in groups for bits in (15, 10, 5, 0)]
    return F.concat(*letters)


def first_of_equal(pages: DataFrame, least_bytes: int = 0, salts: int = 16) -> DataFrame:
    """``_hash``, ``_salt`` and ``_first``: the smallest id of each payload that several pages have.

    Payloads of ``least_bytes`` or more count, told by SHA-256. Every row comes
    ``salts`` times, so that the pages of one payload can be spread over as many keys.
    """
    bigger = pages.where(F.octet_length("payload") >= least_bytes)
    first = bigger.groupBy(F.sha2("payload", 256).alias("_hash")).agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt")
    return first.where("_copies > 1").select("_hash", spread, "_first")


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: Column) -> Column:
    """The page's id out of a record's name; null if it had none."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def _one_line(text: str) -> str:
    """A header's value: no line may end in it."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def member(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str, refers_to: int | None, level: int = 6) -> bytes:
    """One record as one gzip member. Without a payload it is a revisit, that keeps the response's head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = head if payload is None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {record_name(page_id)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if payload is None:
        lines += [f"WARC-Refers-To: {record_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [packer.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + HEAD_END), packer.compress(block), packer.compress(HEAD_END)]
    return b"".join([*parts, packer.flush()])


PAGE_COLUMNS = ["page_id", "url", "digest", "n_bytes"]


def members(pages: DataFrame, least_bytes: int = 0, salts: int = 16) -> DataFrame:
    """``body``, a record as a gzip member without its last byte, and ``last``, that byte.

    Of equal payloads of ``least_bytes`` or more, the page of the smallest id is a
    response and the others revisit it. Pages that share the smallest id, or that
    have no id among pages without one, are all responses. Payloads are packed
    before they are shuffled to what is known of their copies, of which a revisit keeps nothing.
    """
    hashed = pages.select(
        "page_id",
        "url",
        "payload",
        base32_digest(F.col("payload")).alias("digest"),
        F.octet_length("payload").cast("long").alias("n_bytes"),
        F.sha2("payload", 256).alias("_hash"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).alias("_salt"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            made = [member(*(row[c] for c in ("page_id", "url", "payload", "n_bytes", "digest")), None) for row in rows]
            kept = [batch[c] for c in (*PAGE_COLUMNS, "_hash", "_salt")]
            yield pa.record_batch([*kept, pa.array(made, pa.binary())], [*PAGE_COLUMNS, "_hash", "_salt", "packed"])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["refers_to"] is None:
                    made.append(row["packed"])
                else:
                    made.append(member(row["page_id"], row["url"], None, row["n_bytes"], row["digest"], row["refers_to"]))
            last = pa.array([x[-1] for x in made], pa.int32())
            yield pa.record_batch([last, pa.array([x[:-1] for x in made], pa.binary())], ["last", "body"])

    packed = hashed.mapInArrow(pack, "page_id long, url string, digest string, n_bytes long, _hash string, _salt long, packed binary")
    joined = packed.join(first_of_equal(pages, least_bytes, salts), ["_hash", "_salt"], "left")
    repeats = F.coalesce(F.col("page_id") != F.col("_first"), F.col("_first").isNotNull())
    refers = F.when(repeats, F.col("_first")).alias("refers_to")
    return joined.select(*PAGE_COLUMNS, refers, F.when(refers.isNull(), F.col("packed")).alias("packed")).mapInArrow(finish, "last int, body binary")


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record for each page, in gzip members, in the files of folder ``path``.

    A null text has an empty payload, a null address no such header. Spark's text writer puts the members
    into files, with its protocol for lost tasks, on any file system: a member
    ends with the highest byte of its length, which is what the writer puts after
    each row. That byte is zero below 16 MiB; the few longer records are further
    files, one write for each value of the byte that there is.
    """
    ship_package(pages.sparkSession)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"))
    made = staged(members(named, least_bytes), "members")
    values = [last for (last,) in made.select("last").distinct().collect()]
    for last in sorted(values) or [0]:
        rows = made.where(F.col("last") == last).select(F.col("body").cast("string").alias("value"))
        rows.write.mode("append").option("encoding", "ISO-8859-1").option("lineSep", chr(last)).text(path)


class Range:
    """The records that start in one byte range of a file."""

    def __init__(self, source, start: int, stop: int):
        self.source, self.start, self.stop = source, start, stop
        self.base, self.held, self.ended = start, b"", False

    def _more(self) -> bool:
        got = b"" if self.ended else self.source.read(STEP)
        self.ended = not got
        self.held += got
        return bool(got)

    def _drop(self, upto: int) -> None:
        self.held, self.base = self.held[upto - self.base :], upto

    def _candidate(self, at: int) -> int | None:
        """The next place at or after ``at``, inside the range, that has the magic."""
        while True:
            found = self.held.find(MAGIC, at - self.base)
            if found >= 0:
                return self.base + found if self.base + found < self.stop else None
            # The magic may lie across two reads.
            at = max(at, self.base + len(self.held) - len(MAGIC) + 1)
            if at >= self.stop or not self._more():
                return None
            self._drop(min(at, self.base + len(self.held)))

    def _decode(self, at: int) -> tuple[bytes, int] | None:
        """The content and end of the member at ``at``, or None if it isn't a whole WARC record."""
        unpacker, used, content = zlib.decompressobj(31), at - self.base, bytearray()
        while not unpacker.eof:
            piece = self.held[used : used + STEP]
            if not piece and not self._more():
                return None
            used += len(piece)
            try:
                content += unpacker.decompress(piece)
            except zlib.error:
                return None
            if not content.startswith(VERSION[: len(content)]):
                return None
        whole = content.startswith(VERSION)
        return (bytes(content), self.base + used - len(unpacker.unused_data)) if whole else None

    def records(self) -> Iterator[tuple[int, int, bytes]]:
        self.source.seek(self.start)
        at = self.start
        while at is not None and (at := self._candidate(at)) is not None:
            self._drop(at)
            decoded = self._decode(at)
            if decoded is None:
                at += 1
            else:
                content, end = decoded
                yield at, end, content
                at = end if end < self.stop else None


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def parsed(content: bytes) -> dict | None:
    """The fields of a record; None if it isn't complete.

    A payload's length and digest are those of its bytes, for a revisit those that its headers keep.
    """
    head, mark, rest = content.partition(HEAD_END)
    headers = _headers(head)
    length = headers.get("content-length", "")
    if not mark or not length.isdigit() or len(rest) < int(length):
        return None
    block, kind = rest[: int(length)], headers.get("warc-type")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload, n_bytes = block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(HEAD_END)
        n_bytes = len(payload)
        if kind == "revisit":
            stated = _headers(http).get("content-length", "")
            n_bytes = int(stated) if stated.isdigit() else None
    if kind == "revisit":
        payload = None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_type": kind,
        "record_id": headers.get("warc-record-id"),
        "uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "digest": digest,
        "payload_bytes": n_bytes,
        "payload": payload,
    }


def byte_ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """``file``, ``start`` and ``stop`` of ranges that cover every file; only sizes are read."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    return files.select("file", "length", F.explode(starts).alias("start")).select("file", "start", F.least("length", F.col("start") + range_bytes).alias("stop"))


def read_archives(spark: SparkSession, path: str, range_bytes: int = 64 << 20, payloads: bool = True) -> DataFrame:
    """Every record of the files under ``path``: its place, type, names, digest and payload.

    Each range is a task of its own. The file system must be one that Arrow
    opens on the executors (local, HDFS, object stores). A false start needs the
    three bytes of the magic and a whole member after it that decodes to a WARC
    header, so it needs an archive stored inside a record without compression;
    ``outermost`` leaves those out. Broken members are passed over. ``payloads``
    False leaves the payload null, where its length and digest are enough.
    """
    ship_package(spark)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = [field.split()[0] for field in RECORDS.split(", ")]
        kinds = {"offset": pa.int64(), "stop": pa.int64(), "range_start": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(name, kinds.get(name, pa.string())) for name in names])
        held, size = [], 0
        for batch in batches:
            for place in batch.to_pylist():
                system, name = fs.FileSystem.from_uri(place["file"])
                with system.open_input_file(name) as source:
                    for offset, stop, content in Range(source, place["start"], place["stop"]).records():
                        fields = parsed(content)
                        if fields is None:
                            continue
                        if not payloads:
                            fields["payload"] = None
                        held.append({"file": place["file"], "offset": offset, "stop": stop, "range_start": place["start"], **fields})
                        size += len(fields["payload"] or b"") + 256
                        if size > STEP:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    ranges = byte_ranges(spark, path, range_bytes)
    # The number is given, as otherwise adaptive execution puts these few short rows into one task.
    return ranges.repartition(max(1, ranges.count())).mapInArrow(scan, RECORDS)


def outermost(records: DataFrame) -> DataFrame:
    """Records that don't lie inside a record that began in an earlier range of the same file.

    Only a range's last record reaches beyond it, so one row for each range
    tells how far its file is covered: a table as long as the archives have ranges.
    """
    ends = records.groupBy(F.col("file").alias("_file"), F.col("range_start").alias("_range")).agg(F.max("stop").alias("_stop"))
    before = W.partitionBy("_file").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    covered = ends.select("_file", "_range", F.max("_stop").over(before).alias("_covered"))
    met = records.join(covered, (F.col("file") == F.col("_file")) & (F.col("range_start") == F.col("_range")))
    return met.where(F.col("_covered").isNull() | (F.col("offset") >= F.col("_covered"))).drop("_file", "_range", "_covered")
