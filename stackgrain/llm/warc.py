"""Pages as WARC archives: written as whole-file gzip streams, normalised to a gzip member a record, read by offset.

``write_archives`` writes records as crawlers' tools often do, a file being one gzip stream that can only be read from
its start. ``normalise`` is the monolithic gzip normaliser: it inflates each file's stream once, in pieces of bounded
size, writes every record as a member of its own into a new file, and beside it a sidecar index with a line for each
record (offset, length, type, record id). It takes files of one member, of many, or uncompressed ones.
``read_archives`` deals the lines of the indexes to tasks and inflates single members at their offsets.

Equal payloads are stored once: of records with equal payloads of at least ``least_bytes`` the one with the largest page id is the
response and the others are revisits, which keep the HTTP headers (with the payload's length), its digest, and the
response's record id. Payloads are compared by their SHA-1, which is counted before it is joined, so that a frequent payload is one row of that join's
small side.

Files go to the shared folder through pyarrow's file systems, under names that no other attempt of a task uses; what a
task wrote is named by the rows that it returns, stored as Parquet, so files of lost or repeated attempts are never
read. A task holds one record at a time.

Null html is an empty payload. Null urls get the record id in their place; white space and control characters in urls are percent-encoded. Repeated rows are records of
their own: those with the largest page id are all responses. A null page id counts as the smallest; pages that revisit
it have a null refers_to. An empty table gives no records. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stored

INDEX = "file string, offset long, length long, record_type string, record_id string"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, date string, "
           "file string, offset long, member_bytes long")  # fmt: skip
PIECE = 1 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: the profile's name


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    """The page of a record id; None for the id of a page without one, or no id."""
    own = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(own) if own not in ("", "none") else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: bool, refers_to: int | None, date: str) -> bytes:
    """One WARC record with its closing blank lines. payload: the full one, also for revisits, which do not store it."""
    name = record_id(page_id)
    target = re.sub(r"[\s\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else name[1:-1]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisits else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}", f"WARC-Target-URI: {target}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisits:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header lines after the first, by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def inflated(source) -> Iterator[bytes]:
    """The bytes of a stream, inflated if it is gzip (of one member or many), in pieces of bounded size. A stream that
    ends inside a member fails."""
    data = source.read(PIECE)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = source.read(PIECE)
        return
    member = zlib.decompressobj(31)
    while data or (data := source.read(PIECE)):
        yield member.decompress(data, PIECE)
        data = member.unconsumed_tail
        if member.eof:
            data = member.unused_data.lstrip(b"\0") or source.read(PIECE)
            if not data:
                return
            member = zlib.decompressobj(31)
    while tail := member.decompress(b"", PIECE):  # what the limit of the last piece held back
        yield tail
    if not member.eof:
        raise EOFError("the gzip stream is cut off")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, record with its closing blank lines) of inflated WARC bytes. Blank lines between records count for
    nothing; a record that is cut off fails."""
    held = bytearray()
    for piece in pieces:
        held += piece
        yield from _complete(held)
    if held.strip(b"\r\n"):
        raise EOFError("the last record is cut off")


def _complete(held: bytearray) -> Iterator[tuple[dict[str, str], bytes]]:
    """Takes the whole records off the front of held."""
    at = 0
    while True:
        while held[at : at + 1] in (b"\r", b"\n"):
            at += 1
        end = held.find(b"\r\n\r\n", at)
        if end < 0:
            break
        head = bytes(held[at:end])
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:20]!r}")
        own = fields(head)
        stop = end + 4 + int(own["content-length"])
        if len(held) < stop + 4 and not held[stop:].startswith(b"\r\n\r\n"):
            break
        yield own, bytes(held[at:stop]) + b"\r\n\r\n"
        at = stop
    del held[:at]


def _new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a new folder in the shared one. A path without a scheme is in Hadoop's default file system."""
    base = shared_dir(spark)
    if "://" not in base and not base.startswith("file:"):
        base = f"{spark.sparkContext._jsc.hadoopConfiguration().get('fs.defaultFS').rstrip('/')}/{base.lstrip('/')}"
    uri = re.sub(r"^file:/*", "file:///", f"{base}/{name}-{uuid.uuid4().hex}")
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return uri


def linked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html as bytes, digest, revisits, refers_to): which records are revisits, and of which page."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.sha1(html).alias("digest"))
    shared = (
        own.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.count("*").alias("copies"), F.max("page_id").alias("keeper"))
        .where("copies > 1").select("digest", "keeper", F.lit(True).alias("shared"))
    )
    both = own.join(shared, "digest", "left")
    revisits = F.coalesce("shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return both.select("page_id", "url", "html", "digest", revisits.alias("revisits"), F.when(revisits, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, least_bytes: int = 0, file_bytes: int = 64 << 20, level: int = 1, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(file, n_records): monolithic archives of all pages, of about so many bytes before compression."""
    folder = _new_folder(pages.sparkSession, "crawl")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        sink = pack = None
        size = n = 0

        def ended() -> pa.RecordBatch:
            sink.write(pack.flush())
            sink.close()
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n_records": pa.array([n], pa.int64())})

        for batch in batches:
            for page_id, url, html, digest, revisits, refers_to in zip(*batch.columns, strict=True):
                if sink is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink, pack = system.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                b32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                data = record(page_id.as_py(), url.as_py(), html.as_py(), b32, revisits.as_py(), refers_to.as_py(), date)
                sink.write(pack.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield ended()
                    sink = None
        if sink is not None:
            yield ended()

    return stored(linked(pages, least_bytes).mapInArrow(run, "file string, n_records long"), "crawl-files")


def normalise(archives: DataFrame, level: int = 6) -> DataFrame:
    """(file, offset, length, record_type, record_id): the index of new archives, a gzip member a record, made of those
    that (file) names. Each new file x.warc.gz has the same lines, tab-separated, in x.warc.gz.idx beside it."""
    spark = archives.sparkSession
    folder = _new_folder(spark, "warc")
    names = [x.split()[0] for x in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for place in batch.column("file").to_pylist():
                source, at = fs.FileSystem.from_uri(place)
                name = f"{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with (
                    source.open_input_stream(at, compression=None) as stream,
                    system.open_output_stream(f"{path}/{name}", compression=None) as out,
                    system.open_output_stream(f"{path}/{name}.idx", compression=None) as index,
                ):
                    for own, data in split_records(inflated(stream)):
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = pack.compress(data) + pack.flush()
                        out.write(member)
                        row = (offset, len(member), own["warc-type"], own["warc-record-id"])
                        index.write("\t".join(map(str, row)).encode() + b"\n")
                        rows.append((f"{folder}/{name}", *row))
                        offset += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names) if rows else _none(INDEX)

    # A file is a task's work: as many tasks as files, however few rows name them.
    files = max(1, archives.count())
    return stored(archives.select("file").repartition(files, "file").mapInArrow(run, INDEX), "warc-index")


def _none(schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_pydict({n: pa.array([], kinds[k]) for n, k in (x.split() for x in schema.split(", "))})


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a folder of normalised archives, from its sidecars: for archives of which no table is kept."""
    lines = spark.read.option("sep", "\t").schema("offset long, length long, record_type string, record_id string").csv(f"{folder}/*.warc.gz.idx")
    file = F.regexp_replace(F.regexp_replace(F.input_file_name(), r"\.idx$", ""), "^file:/*", "file:///")
    return lines.select(file.alias("file"), "offset", "length", "record_type", "record_id")


def parse_member(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one gzip member that holds one record. For a revisit the payload is empty."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    own = fields(head)
    http, _, payload = rest[: int(own["content-length"])].partition(b"\r\n\r\n")
    return own, fields(http), payload


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """One row a record of RECORDS, read at its offset. Lengths and digests are those of the full payload: of responses
    computed from what was read (and held against the record's own digest), of revisits as the record states them.
    payloads: with a column payload, null for revisits."""
    schema = RECORDS + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = stream = None
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                rows = []
                for name, offset, length, kind in zip(*(c.to_pylist() for c in batch.slice(k, 200).columns), strict=True):
                    if name != place:
                        if stream is not None:
                            stream.close()
                        system, path = fs.FileSystem.from_uri(name)
                        place, stream = name, system.open_input_file(path)
                    stream.seek(offset)
                    own, http, payload = parse_member(stream.read(length))
                    digest = own["warc-payload-digest"].removeprefix("sha1:")
                    size = int(http["content-length"])
                    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"the payload of {own['warc-record-id']} is damaged")
                    rows.append((page_of(own["warc-record-id"]), size, digest, own["warc-type"], page_of(own.get("warc-refers-to")), own["warc-target-uri"],
                                 own["warc-date"], name, offset, length, *[None if kind == "revisit" else payload] * payloads))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return index.select("file", "offset", "length", "record_type").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, least_bytes: int = 0, file_bytes: int = 64 << 20) -> DataFrame:
    """Pages written to archives, normalised, and read back: RECORDS."""
    return read_archives(normalise(write_archives(pages, least_bytes, file_bytes)))
