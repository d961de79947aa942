"""WARC archives in Zstandard with a dictionary of their own.

An archive is a file of Zstandard frames: first a skippable frame with the dictionary (itself compressed), then one frame a
record, so that a record can be read with the dictionary alone. A task fills one archive after another: the first records of
each are what its dictionary is trained on. Spark's text writer puts the frames into files of any file system, with its usual
commit; between rows it needs a separator, and an empty skippable frame is one that readers of Zstandard pass over."""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bits_for, made, map_in_arrow, maybe_in, row_count_at_most, shared_dir, written

# Fixed values of the formats.
DICTIONARY_MAGIC, SKIPPABLE, FRAME_MAGIC, TRAINED_MAGIC = b"\x5d\x2a\x4d\x18", b"\x2a\x4d\x18", b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
EMPTY_FRAME = "P*M\x18\0\0\0\0"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of a dictionary, and of the records that it is trained on; of one record at most SLICE bytes are used for that.
DICTIONARY, SAMPLE, SLICE = 32 << 10, 1 << 20, 64 << 10
#: A row of the text writer holds frames of so many bytes (or one longer frame), an archive so many rows.
PIECE, PIECES = 1 << 20, 48
LEVEL = 3
SMALL = 50_000


def first_ids(pages: DataFrame, least: int) -> DataFrame:
    """payload (SHA-256) and first_id of payloads of at least so many bytes that several rows share."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keys = pages.select(F.unhex(F.sha2(html, 256)).alias("payload"), "page_id").where(F.octet_length(html) >= least)
    return keys.groupBy("payload").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1").drop("n")


def records(pages: DataFrame, least: int) -> DataFrame:
    """Rows of page_id, url, payload (null for revisits), n_bytes, sha1 (hex) and first_id (of revisits).

    Payloads that several rows share are few or many: few are broadcast; of many, a bitmap of fixed size tells rows that
    can't be among them, and only the others move to meet them."""
    firsts = written(first_ids(pages, least), "warc-firsts")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumn("payload", F.unhex(F.sha2("html", 256)))
    if row_count_at_most(firsts, SMALL):
        joined = rows.join(F.broadcast(firsts), "payload", "left")
    else:
        bits = bits_for(firsts.count())
        flagged = maybe_in(rows, F.col("payload"), bitmap(firsts, "payload", bits), bits, "shared")
        joined = flagged.where("shared").join(firsts, "payload", "left").drop("shared").unionByName(flagged.where("not shared").drop("shared"), allowMissingColumns=True)
    again = F.col("first_id").isNotNull() & (F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(~again, F.col("html").cast("binary")).alias("payload"), F.octet_length("html").cast("long").alias("n_bytes"), F.sha1("html").alias("sha1"),
        F.when(again, F.col("first_id")).alias("first_id"),
    )


def name_of(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, sha1: str, first_id: int | None, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP head of the full payload, and no payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    safe = "".join(map(chr, range(0x21, 0x7F)))
    head = ["WARC/1.1", f"WARC-Type: {'response' if first_id is None else 'revisit'}", f"WARC-Record-ID: {name_of(page_id)}", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {urllib.parse.quote(url, safe=safe) if url else name_of(page_id)[1:-1]}", f"WARC-Payload-Digest: sha1:{digest}"]
    if first_id is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {name_of(first_id)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(sample: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the sample; none if it is too small or too uniform to train one."""
    slices = [r[:SLICE] for r in sample]
    try:
        return zstandard.train_dictionary(min(DICTIONARY, sum(map(len, slices)) // 4), slices, k=256, d=8, level=LEVEL)
    except zstandard.ZstdError:
        return None


def skippable(content: bytes) -> bytes:
    return DICTIONARY_MAGIC + len(content).to_bytes(4, "little") + content


def pieces_of(rows: Iterable[bytes], piece_bytes: int, pieces: int, sample_bytes: int) -> Iterator[bytes]:
    """The rows of the text writer for a task's records: archives of so many rows, each with its dictionary first."""
    rows = iter(rows)
    more = True
    while more:
        sample, size = [], 0
        while size < sample_bytes and (r := next(rows, None)) is not None:
            sample.append(r)
            size += len(r)
        if not sample:
            return
        dictionary, room = trained(sample), pieces
        if dictionary is not None:
            yield skippable(zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes()))
            room -= 1
            dictionary.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        piece, n = [], 0
        waiting = iter(sample)
        while room:
            r = next(waiting, None)
            if r is None and (r := next(rows, None)) is None:
                more = False
                break
            piece.append(press.compress(r))
            n += len(piece[-1])
            if n >= piece_bytes:
                yield b"".join(piece)
                piece, n, room = [], 0, room - 1
        rest = list(waiting)  # records of the sample that found no room, as they were very long
        rows = _after(rest, rows) if rest else rows
        if piece:
            yield b"".join(piece)


def _after(first: list[bytes], then: Iterator[bytes]) -> Iterator[bytes]:
    yield from first
    yield from then


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", piece: int = PIECE, pieces: int = PIECES, sample: int = SAMPLE) -> None:
    """Writes a record for each row of pages (page_id, url, html; other columns don't matter) into archives under path.

    Of rows with equal payloads (html in UTF-8, null as empty) of at least `least` bytes, those with the smallest page_id are
    responses and the others revisits of it; null ids count as largest, and rows that share only null ids are all responses.
    Rows that repeat the smallest id are all responses. Every row gives a record; no row gives no archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (record(*row, date) for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True))
        for value in pieces_of(rows, piece, pieces, sample):
            yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])

    frames = map_in_arrow(records(pages, least), run, "value binary")
    frames.select(F.col("value").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", pieces).option("compression", "none").text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at a place ends, from its header and those of its blocks."""
    flags = data[at + 4]
    one = flags >> 5 & 1
    at += 5 + (1 - one) + (0, 1, 2, 4)[flags & 3] + (one, 2, 4, 8)[flags >> 6]
    last = 0
    while not last:
        head = int.from_bytes(data[at : at + 3], "little")
        last = head & 1
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    return at + 4 * (flags >> 2 & 1)


def frames_of(data: memoryview) -> Iterator[bytes]:
    """The records of an archive, decompressed with its dictionary."""
    at, press = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = bytes(data[at : at + 4])
        if magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield press.decompress(data[at:end])
            at = end
        elif magic[1:] == SKIPPABLE:
            content = data[at + 8 : at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")]
            if magic == DICTIONARY_MAGIC:
                plain = bytes(content) if bytes(content[:4]) == TRAINED_MAGIC else zstandard.ZstdDecompressor().decompress(content)
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(plain))
            at += 8 + len(content)
        else:
            raise ValueError(f"no Zstandard frame at byte {at}")


def parsed(data: bytes) -> tuple:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest and payload of a record. Size and digest of a
    response are those of its payload as read; a revisit states those of the payload it refers to."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']} doesn't end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    page_id, url = page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"]
    if fields["WARC-Type"] == "revisit":
        n = int(http.decode().rpartition("Content-Length: ")[2])
        return page_id, url, "revisit", page_of(fields["WARC-Refers-To"]), n, fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"{fields['WARC-Record-ID']} has another payload than its digest says")
    return page_id, url, "response", None, len(payload), digest, payload


RECORDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under path: page_id, url, record_type, refers_to, payload_bytes, payload_digest and, unless
    it isn't wanted, payload (null for revisits). Payloads are held against their digests in any case."""
    names = [c for c in RECORDS if payloads or c != "payload"]
    schema = pa.schema([(c, RECORDS[c]) for c in names])
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for data in frames_of(memoryview(content.as_buffer())):
                    rows.append(parsed(data)[: len(names)])
                    size += len(data) * payloads + 200
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return map_in_arrow(files, run, ", ".join(f"{c} {kinds[RECORDS[c]]}" for c in names))


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages written to archives in the shared folder and read back, without payloads."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least)
    made.append(path)
    return read_archives(spark, path, payloads=False)
