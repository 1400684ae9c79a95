"""WARC archives, and making monolithic gzip archives seekable.

``write_archives`` writes records into whole-file gzip archives, as a careless producer would:
one stream over many records, so no record can be read without all before it. ``normalise``
inflates each such file once from front to back, writes every record as a gzip member of its
own, and a sidecar index with the offset and length of each. ``read_records`` then reads single
members through the index and checks them against their digests.

Records with the payload of an earlier one are revisits: they name the record that has it and
carry only its HTTP header.

Files go to a folder all executors share and are opened through its file system on the executors;
a task writes under a name of its own, and only names that a finished task returned are used, so
tasks may be lost or run twice. Streams are handled in chunks: what a task holds is one record's
block at most.

Defined cases: a null payload is an empty one; a record without a URL has no target; ids may be
null (such a record never is the one that others revisit); of rows with the smallest id of their
payload, if that id is repeated, all are responses; empty tables give no archives and no records.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstream.session import materialise, shared_dir

MIN_PAYLOAD = 100  # bytes; smaller payloads are not worth a reference
ARCHIVE_BYTES = 256 << 20  # of records in an archive, before compression
CHUNK = 1 << 18
WRITE_LEVEL, MEMBER_LEVEL = 1, 6
GZIP = 31  # zlib's window bits for a gzip wrapper

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
RESPONSE_BLOCK = "application/http;msgtype=response"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables have no fetch times

INDEX_SCHEMA = ("archive string, offset long, length long, type string, record_id string, "
                "target string")
RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, target string, archive string, offset long")


# ---- files ----------------------------------------------------------------------------------

def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder, on the machine that asks."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# ---- records --------------------------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    name = "none" if page_id is None else str(page_id)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + name)}>"


def _header(fields: list[tuple[str, str | None]], length: int) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields if value is not None]
    return VERSION + "".join(lines).encode() + b"Content-Length: %d\r\n\r\n" % length


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None) -> tuple[bytes, list[bytes]]:
    """(header, parts of the block) of a response, or of a revisit if ``refers_to`` is set."""
    target = None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", target or None), ("Content-Type", RESPONSE_BLOCK),
        ("WARC-Payload-Digest", "sha256:" + digest),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-ID", None if page_id is None else str(page_id)),
    ]
    block = [HTTP_HEAD, payload]
    if refers_to is not None:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to)),
                   ("X-Refers-To-Page-ID", str(refers_to))]
        block = [HTTP_HEAD]
    return _header(fields, sum(map(len, block))), block


def _info_record() -> tuple[bytes, list[bytes]]:
    block = b"format: WARC File Format 1.1\r\n"
    return _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None)),
                    ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                   len(block)), [block]


def parse_header(data: bytes) -> dict[str, str]:
    """Field names in lower case. Folded lines continue the field before them."""
    if not data.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {data[:40]!r}")
    fields, last = {}, None
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


# ---- inflating ------------------------------------------------------------------------------

class Inflated:
    """A gzip file as a stream of its content, also if it has several members."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read_raw, self.engine = read, zlib.decompressobj(GZIP)
        self.held, self.at, self.pending = b"", 0, b""
        self.begun = self.ended = False

    def _more(self) -> bool:
        """Append inflated bytes to what is held; False at the end."""
        while not self.ended:
            if self.engine.eof:
                self.pending = self.engine.unused_data or self.read_raw(CHUNK)
                if not self.pending:
                    self.ended = True
                    return False
                self.engine = zlib.decompressobj(GZIP)
            raw = self.engine.unconsumed_tail or self.pending or self.read_raw(CHUNK)
            self.pending = b""
            if not raw and not self.begun:
                self.ended = True  # an empty file
                return False
            self.begun = True
            out = self.engine.decompress(raw, CHUNK)
            if not raw and not out and not self.engine.eof:
                raise EOFError("a gzip stream breaks off")
            if out:
                self.held = self.held[self.at:] + out
                self.at = 0
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and with ``mark``; None at the end of the file."""
        while True:
            found = self.held.find(mark, self.at)
            if found >= 0:
                start, self.at = self.at, found + len(mark)
                return self.held[start:self.at]
            if not self._more():
                if self.at < len(self.held):
                    raise EOFError("a record breaks off")
                return None

    def chunks(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in pieces."""
        while length:
            if self.at >= len(self.held) and not self._more():
                raise EOFError("a record breaks off")
            piece = self.held[self.at:self.at + length]
            self.at += len(piece)
            length -= len(piece)
            yield piece


def records(stream: Inflated) -> Iterator[tuple[bytes, dict[str, str], Iterator[bytes]]]:
    """(header bytes, fields, chunks of the block) of each record. A block must be read before
    the next record is asked for."""
    while (header := stream.until(b"\r\n\r\n")) is not None:
        fields = parse_header(header)
        yield header, fields, stream.chunks(int(fields["content-length"]))
        if b"".join(stream.chunks(4)) != b"\r\n\r\n":
            raise ValueError("a record does not end where its header says")


# ---- writing monolithic archives ------------------------------------------------------------

def with_record_types(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``pages`` (page_id, url, payload: binary) with digest and refers_to.

    Payloads are compared by digest. Which pages revisit which is worked out on ids and digests
    alone and joined to the payloads by page, so copies of one payload meet nowhere.
    """
    known = pages.withColumn("digest", F.sha2("payload", 256))
    slim = known.select("page_id", "digest", F.length("payload").alias("bytes")).filter(
        F.col("bytes") >= min_payload)
    # Written, so that the join sees a plain shuffle on both sides and can split hot digests.
    first = materialise(slim.groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter(
        F.col("first").isNotNull() & (F.col("n") > 1)).select("digest", "first"), "firsts")
    again = slim.join(first, "digest").filter(
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    again = materialise(again.select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"),
        F.col("first").alias("refers_to")).distinct(), "revisits")
    return known.join(again, F.col("page_id").eqNullSafe(F.col("_page"))
                      & (F.col("digest") == F.col("_digest")), "left").drop("_page", "_digest")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, payload, digest, refers_to) as monolithic archives in
    ``folder`` and return their names."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        out, names = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in batch.itertuples(index=False):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = system.open_output_stream(f"{path}/{names[-1]}", compression=None)
                    engine = zlib.compressobj(WRITE_LEVEL, zlib.DEFLATED, GZIP)
                    held = _put(out, engine, *_info_record())
                held += _put(out, engine, *page_record(
                    _number(page_id), url, bytes(payload), digest, _number(refers_to)))
                if held >= archive_bytes:
                    out.write(engine.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(engine.flush())
            out.close()
        if names:
            yield pd.DataFrame({"archive": names})

    # Ids as text: a column with nulls would reach Python as floating-point numbers.
    rows = pages.select(F.col("page_id").cast("string"), "url", "payload", "digest",
                        F.col("refers_to").cast("string"))
    return materialise(rows.mapInPandas(write, "archive string"), "archives")


def _number(text: str | None) -> int | None:
    return int(text) if isinstance(text, str) else None


def _put(out, engine, header: bytes, block: list[bytes]) -> int:
    for part in (header, *block, b"\r\n\r\n"):
        out.write(engine.compress(part))
    return len(header) + sum(map(len, block)) + 4


# ---- normalising ----------------------------------------------------------------------------

def normalise_file(read: Callable[[int], bytes], write: Callable[[bytes], object]
                   ) -> Iterator[dict]:
    """Rewrite one archive record by record; yields an index entry for each."""
    offset = 0
    for header, fields, block in records(Inflated(read)):
        engine, length = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, GZIP), 0
        for part in (header, *block, b"\r\n\r\n"):
            length += _emit(write, engine.compress(part))
        length += _emit(write, engine.flush())
        yield {"offset": offset, "length": length, "type": fields.get("warc-type"),
               "record_id": fields.get("warc-record-id"), "target": fields.get("warc-target-uri")}
        offset += length


def _emit(write, data: bytes) -> int:
    if data:
        write(data)
    return len(data)


def normalise(archives: DataFrame, folder: str, target: str) -> DataFrame:
    """Normalise the named archives of ``folder`` into ``target``; returns the new names.

    One archive is one task's work, as only its start can be found; archives are dealt out one
    by one. Beside ``<name>`` lies ``<name>.index``, a line of JSON per record.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, source = open_folder(folder)
        _, path = open_folder(target)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for name in batch["archive"]:
                done = f"{uuid.uuid4().hex}.warc.gz"
                with (system.open_input_stream(f"{source}/{name}", compression=None) as inp,
                      system.open_output_stream(f"{path}/{done}", compression=None) as out,
                      system.open_output_stream(f"{path}/{done}.index") as index):
                    for entry in normalise_file(inp.read, out.write):
                        index.write(json.dumps({"archive": done} | entry).encode() + b"\n")
                yield pd.DataFrame({"archive": [done]})

    tasks = max(1, archives.count())
    dealt = archives.repartition(min(tasks, 10_000))
    return materialise(dealt.mapInPandas(run, "archive string"), "normalised")


# ---- reading --------------------------------------------------------------------------------

def read_index(spark: SparkSession, archives: DataFrame, target: str) -> DataFrame:
    """The sidecars of the named archives; files of tasks that were lost are left out."""
    entries = spark.read.schema(INDEX_SCHEMA).json(f"{target}/*.index")
    return entries.join(archives, "archive", "left_semi")


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record from its gzip member."""
    content = zlib.decompress(data, GZIP)
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = parse_header(head + b"\r\n\r\n")
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its header says")
    return fields, rest[:length]


def read_records(index: DataFrame, target: str) -> DataFrame:
    """The page records an index names, each read by its offset alone.

    A response's payload is measured and its digest compared; a revisit has both from the
    record it refers to, through its header.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = open_folder(target)
        for batch in batches:
            rows = []
            for name, group in batch.groupby("archive", sort=False):
                with system.open_input_file(f"{path}/{name}") as archive:
                    for offset, length in zip(group["offset"], group["length"]):
                        rows.append(_page_row(
                            *read_member(archive.read_at(int(length), int(offset))), name, offset))
            if rows:
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in RECORD_SCHEMA.split(", ")],
                                   dtype=object)

    chosen = index.filter(F.col("type").isin("response", "revisit")).select(
        "archive", "offset", "length")
    schema = RECORD_SCHEMA.replace("page_id long", "page_id string").replace(
        "refers_to long", "refers_to string")
    found = chosen.mapInPandas(run, schema)
    return found.withColumns({name: F.col(name).cast("long") for name in ("page_id", "refers_to")})


def _page_row(fields: dict[str, str], block: bytes, archive: str, offset: int) -> tuple:
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        length = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record at {offset} of {archive} does not match its digest")
    else:
        length = int(fields["x-payload-length"])
    return (fields.get("x-page-id"), length, digest, fields["warc-type"],
            fields.get("x-refers-to-page-id"), fields.get("warc-target-uri"), archive, int(offset))


def through_archives(pages: DataFrame, payload: str = "html", folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, payload) into archives, normalise them and read every
    record back: the columns of ``RECORD_SCHEMA``."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    raw, target = f"{folder}/raw", f"{folder}/normalised"
    bodies = pages.select("page_id", "url", F.coalesce(
        F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    archives = write_archives(with_record_types(bodies), raw)
    done = normalise(archives, raw, target)
    if not archives.limit(1).count():
        return spark.createDataFrame([], RECORD_SCHEMA)
    return read_records(read_index(spark, done, target), target)
