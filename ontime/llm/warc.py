"""WARC archives whose records are Zstandard frames under a dictionary built from the records themselves."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from uuid import NAMESPACE_URL, uuid4, uuid5

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import fresh_folder, prepare_workers, stage

# The format's magic number of a dictionary frame, and Zstandard's own.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"

DICTIONARY_BYTES = 1 << 16
SAMPLE_RECORDS = 400
SAMPLE_CHARS = 50_000
LEAST_BYTES = 1000
LEVEL = 6
FILE_BYTES = 1 << 27
READ_TASKS = 10_000  # at most, for any number of archives
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def build_dictionary(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary of at most ``DICTIONARY_BYTES`` from at most ``SAMPLE_RECORDS`` different payloads of at most
    ``SAMPLE_CHARS`` characters each, the ones with the smallest hashes; empty when there are too few to train on.

    Hashes are chosen first, so that no task sends payloads that are not wanted. Only the dictionary depends on the
    sample: records hold whole payloads.
    """
    usable = pages.where(F.length(html).between(1, SAMPLE_CHARS)).select(F.xxhash64(html).alias("_h"), F.col(html).alias("_payload"))
    hashes = [r["_h"] for r in usable.select("_h").distinct().orderBy("_h").limit(SAMPLE_RECORDS).collect()]
    wanted = usable.where(F.col("_h").isin(hashes)).groupBy("_h").agg(F.min("_payload").alias("_payload"))
    samples = [r["_payload"].encode() for r in wanted.orderBy("_h").collect()]  # bounded by the two limits
    if sum(map(len, samples)) < 4 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little in common
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame that holds the dictionary, itself compressed."""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def decide_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, refers_to): for every page whether it repeats the payload of another.

    Of equal payloads of at least ``least_bytes`` the page with the largest page_id is the response, the others refer to
    it; refers_to is null for responses. Only identifiers and digests are shuffled, pre-aggregated per task.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    digests = stage(
        pages.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.length(payload).alias("_bytes")), "payloads"
    )
    long = digests.where(F.col("_bytes") >= least_bytes)
    last = long.groupBy("digest").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = digests.join(last.drop("_n"), "digest", "left")
    return joined.select(
        "page_id", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last")).alias("refers_to")
    ).distinct()


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{page_id}:{digest.hex()}')}>"


def _record(page_id, url, payload: bytes, digest: bytes, refers_to) -> bytes:
    head = _HTTP.format(len(payload)).encode()
    response = refers_to is None
    block = head + payload if response else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if not response:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return "".join(c if c.isprintable() else "%" + c.encode().hex().upper() for c in url or "")


def _open(place: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a place; local ones may have any characters in them."""
    if place.startswith("file:"):
        place = "/" + place.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) to archives in ``folder``; returns their list.

    ``folder`` is any path that pyarrow's file systems reach from every executor. Each task writes under names of its
    own, and the list (path, n_records, n_bytes) has only the files of the attempts that succeeded, so a lost executor or
    a repeated task leaves at most files that nothing refers to. A file is closed after ``FILE_BYTES``.
    Pages with the same page_id and payload get records of the same kind.
    """
    spark = pages.sparkSession
    prepare_workers(spark)
    dictionary = build_dictionary(pages)
    decided = stage(decide_records(pages, least_bytes), "decisions").withColumnsRenamed({"page_id": "_p", "digest": "_d"})
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    whole = pages.select("page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    # by page, not by payload: a payload that fills a third of the table is spread evenly
    joined = whole.join(decided, whole["page_id"].eqNullSafe(decided["_p"]) & (whole["digest"] == decided["_d"]))
    listed = "path string, n_records long, n_bytes long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        lead = dictionary_frame(dictionary)
        stream, path, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    name, count, size = f"part-{uuid4().hex}.warc.zst", 0, len(lead)
                    path = f"{folder}/{name}"
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    stream.write(lead)
                frame = packer.compress(_record(*row))
                stream.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= FILE_BYTES:
                    stream.close()
                    done.append((path, count, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "n_records", "n_bytes"])

    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    return stage(joined.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, listed), "archives")


def _frames(stream) -> Iterator[tuple[int, bytes]]:
    """(magic, content) of all frames of a file: skippable ones as they are, records decompressed, one at a time."""
    lead = stream.read(8)
    magic, length = struct.unpack("<II", lead)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    dictionary = zstandard.ZstdDecompressor().decompress(stream.read(length))
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    tool = zstandard.ZstdDecompressor(dict_data=trained)
    rest = b""
    while True:
        one = tool.decompressobj()
        parts = []
        while not one.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    if parts:
                        raise ValueError("the file ends within a record")
                    return
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; both lengths are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length does not match")
    return fields, rest[:length]


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the listed archives: page_id, payload_bytes, payload_digest, record_type, refers_to, and the
    payload itself if asked for (null for revisits). The digest of a response is worked out again from its payload."""
    spark = archives.sparkSession
    prepare_workers(spark)
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                system, place = _open(path)
                with system.open_input_stream(place, compression=None) as stream:
                    for record in _frames(stream):
                        rows.append(_read_record(*parse_record(record), with_payload))
                        held += len(record) if with_payload else 200
                        if held > 4_000_000:
                            yield _as_batch(rows, names, types, with_payload)
                            rows, held = [], 0
                if rows:
                    yield _as_batch(rows, names, types, with_payload)

    paths = archives.select("path")
    n = min(max(archives.count(), 1), READ_TASKS)
    spread = paths.repartition(n, "path")  # a number of its own: by their few bytes the paths would all go to one task
    return spread.mapInArrow(read, kinds + (", payload binary" if with_payload else ""))


def _as_batch(rows: list[tuple], names: list[str], types: list[pa.DataType], with_payload: bool) -> pa.RecordBatch:
    more = ([*names, "payload"], [*types, pa.binary()]) if with_payload else (names, types)
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), more[1], strict=True)]
    return pa.RecordBatch.from_arrays(columns, more[0])


def _read_record(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = fields["WARC-Type"]
    declared = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != declared or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    page, refers = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
    row = (int(page) if page else None, int(fields["X-Payload-Length"]), declared, kind, int(refers) if refers else None)
    return (*row, payload) if with_payload else row


def archived_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write all rows of ``pages`` to archives and read them back: page_id, payload_bytes, payload_digest (of the full
    payload, bare lower-case hexadecimal SHA-1), record_type and refers_to.

    Null html is an empty payload; a null url an empty one; a page without page_id takes part in no comparison by
    identifier: it refers to the largest page_id of its payload, if any. Rows that repeat page_id and payload each get a
    record. Empty table: no archive, empty result; other columns are ignored.
    """
    target = folder or fresh_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, target, least_bytes))
