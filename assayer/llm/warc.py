"""WARC archives with a two-level capture index.

Archives are written as text files whose line separator is the end of a WARC record, so any
file system that Spark writes to can hold them. They are read back as binary files; a record's
length comes from its header, never from a search for the separator.

The capture index has two levels. Captures are sorted by reversed-host key and cut into blocks
of lines, which are compressed; the directory keeps the first and last key of each block. A
lookup scans the directory, decompresses the blocks that can hold the key, loads the archives
that their lines name and cuts the ranges out of them.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.frames import pick, rows
from assayer.sources.scratch import Scratch

VERSION = "WARC/1.1"
END = "\r\n\r\n"
SMALLEST_SHARED = 1000
RECORDS = 2000  # in an archive file
LINES = 3000  # in an index block
DATE = "2000-01-01T00:00:00Z"  # captures carry no time of their own

_CAPTURE = (
    "surt string, page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, file string, offset long, length long"
)
_NAMES = [part.split()[0] for part in _CAPTURE.split(", ")]


def surt(url: str | None) -> str:
    """The key of a URL: host labels reversed, then the path and query. Null and odd URLs sort first."""
    if not url:
        return ")/"
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return f")/{quote(url)}"
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def page_types(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``pages`` with ``payload``, ``payload_digest``, ``payload_bytes``, ``refers_to`` (null for a response).

    Only digests that occur twice, with their largest id, are joined: a table without payloads.
    """
    narrow = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).alias("payload")
    )
    described = narrow.withColumn("payload_digest", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    shared = (
        described.where(F.col("payload_bytes") >= SMALLEST_SHARED)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "newest")
    )
    shared = scratch.stage(shared, "shared")
    older = F.coalesce(F.col("page_id") < F.col("newest"), F.col("newest").isNotNull())
    return described.join(shared, F.col("payload_digest") == F.col("digest"), "left").select(
        *described.columns, F.when(older, F.col("newest")).alias("refers_to")
    )


def _header_text(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archives(pages: DataFrame, path: str, records: int = RECORDS) -> None:
    """Write one WARC record for each row of ``pages(page_id, url, html)`` below ``path``.

    Of records with equal payloads of at least 1000 bytes, the one with the largest id is a
    response; the others revisit it and carry no payload, but its digest and size. A null
    html is an empty payload. A null id revisits if another row has its payload, and is never
    revisited unless all are null. Rows that repeat the largest id are responses. Other columns
    are ignored; an empty table gives archives without records.
    """
    scratch = Scratch(pages.sparkSession)
    typed = page_types(pages, scratch)
    url = F.coalesce(F.col("url"), F.lit(""))
    # A URL in a header must not end its line; every other character may stand as it is.
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "%", "%25"), "\r", "%0D"), "\n", "%0A")
    is_revisit = F.col("refers_to").isNotNull()
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))

    def ident(page_id):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))

    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header_text("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header_text("WARC-Record-ID", ident(F.col("page_id"))),
        _header_text("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(_header_text("WARC-Target-URI", clean)),
        _header_text("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header_text("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            is_revisit,
            F.concat(
                _header_text("WARC-Refers-To", ident(F.col("refers_to"))),
                _header_text(
                    "WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                ),
            ),
        ).otherwise(F.lit("")),
        _header_text("Content-Type", F.lit("text/html; charset=utf-8")),
        _header_text("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    typed.select(F.concat(header, body).alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records
    ).text(path)


def parse(content: bytes, start: int = 0, end: int | None = None) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, payload)`` of each record between two offsets."""
    at, end = start, len(content) if end is None else end
    while at < end:
        head = content.index(b"\r\n\r\n", at)
        lines = content[at:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        first = head + 4
        last = first + int(headers["Content-Length"])
        yield at, last + 4 - at, headers, content[first:last]
        at = last + 4


def _number(ident: str | None) -> int | None:
    inner = (ident or "").removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives below ``path``, with its place and what it says of its payload.

    The digest of a response is computed again from the payload that was read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in rows(batch, "path", "content"):
                out = []
                for offset, length, headers, payload in parse(content):
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(headers["WARC-Payload-Length"])
                    if headers["WARC-Type"] == "response":
                        if (found := hashlib.sha1(payload).hexdigest()) != digest or size != len(payload):
                            raise ValueError(f"{file} at byte {offset}: payload is {found}, not {digest}")
                    url = headers.get("WARC-Target-URI")
                    if url is not None:
                        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    page, refers = _number(headers["WARC-Record-ID"]), _number(headers.get("WARC-Refers-To"))
                    out.append((surt(url), page, url, headers["WARC-Type"], refers, digest, size, file, offset, length))
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, row)) for row in out], _arrow_schema())

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, _CAPTURE)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in _CAPTURE.split(", ")])


def write_index(captures: DataFrame, path: str, lines: int = LINES) -> None:
    """Write the two-level index: ``path/blocks`` of compressed lines and ``path/directory`` of their keys.

    Keys are spread by range on key and id, so that a frequent host takes several blocks and tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def block(part: list[dict]) -> pa.RecordBatch:
            text = "\n".join(json.dumps(x, ensure_ascii=False) for x in part).encode()
            row = [part[0]["surt"], part[-1]["surt"], len(part), zlib.compress(text)]
            types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], ["first_key", "last_key", "n_lines", "lines"]
            )

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= lines:
                yield block(held[:lines])
                held = held[lines:]
        if held:
            yield block(held)

    # Range partitioning reads its input twice, once to sample the keys, so the captures are written first.
    staged = Scratch(captures.sparkSession).stage(captures, "captures")
    ordered = staged.repartitionByRange("surt", "page_id").sortWithinPartitions("surt", "page_id", "file", "offset")
    blocks = ordered.mapInArrow(run, "first_key string, last_key string, n_lines long, lines binary")
    blocks.withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{path}/blocks")
    kept = captures.sparkSession.read.parquet(f"{path}/blocks")
    kept.select("first_key", "last_key", "block", "n_lines").write.parquet(f"{path}/directory")


def _unpack(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (lines,) in rows(batch, "lines"):
                # Lines are split at \n alone: JSON escapes the line ends of its strings.
                found = [json.loads(line) for line in zlib.decompress(lines).decode().split("\n")]
                yield pa.RecordBatch.from_pylist(found, _arrow_schema())

    return blocks.select("lines").mapInArrow(run, _CAPTURE)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All captures of the index, block by block."""
    blocks = spark.read.schema("first_key string, last_key string, n_lines long, lines binary, block long").parquet(
        f"{path}/blocks"
    )
    return _unpack(blocks)


def lookup(spark: SparkSession, path: str, urls: list[str], with_payload: bool = True) -> DataFrame:
    """The captures of some URLs, with ``payload`` cut from the archives.

    The whole directory is scanned, only the blocks found are decompressed, and only the
    files named in them are loaded, whole. A revisit's payload is null; ``refers_to`` names its response.
    """
    keys = sorted({surt(u) for u in urls})
    shared = spark.sparkContext.broadcast(keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            found = []
            for first, last, block in rows(batch, "first_key", "last_key", "block"):
                at = bisect.bisect_left(wanted, first)
                if at < len(wanted) and wanted[at] <= last:
                    found.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["block"])

    near = spark.read.parquet(f"{path}/directory").mapInArrow(search, "block long")
    blocks = spark.read.parquet(f"{path}/blocks").join(near, "block", "left_semi")
    captures = _unpack(blocks).where(F.col("surt").isin(keys))
    if not with_payload:
        return captures
    found = captures.where("record_type = 'response'").groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    files = [r[0] for r in found.select("file").toLocalIterator()]
    if not files:
        return captures.withColumn("payload", F.lit(None).cast("binary"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, ranges in rows(batch, "file", "content", "ranges"):
                for place in ranges:
                    offset, length = place["offset"], place["length"]
                    (record,) = parse(content, offset, offset + length)
                    yield pa.RecordBatch.from_pylist(
                        [{"at_file": file, "at": offset, "payload": record[3]}],
                        pa.schema([("at_file", pa.string()), ("at", pa.int64()), ("payload", pa.binary())]),
                    )

    content = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), "content")
    payloads = content.join(found, "file").mapInArrow(cut, "at_file string, at long, payload binary")
    here = (F.col("file") == F.col("at_file")) & (F.col("offset") == F.col("at"))
    return captures.join(payloads, here, "left").drop("at_file", "at")


def archive(pages: DataFrame, records: int = RECORDS, lines: int = LINES) -> DataFrame:
    """Write archives and index to the scratch folder, and return the captures read back from the index."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    folder = scratch.path
    write_archives(pages, f"{folder}/warc", records)
    scratch.keep_until_exit()
    write_index(read_captures(spark, f"{folder}/warc"), f"{folder}/index", lines)
    return read_index(spark, f"{folder}/index")
