"""WARC archives with a two-level capture index.

Records are built and written by built-in expressions through Spark's text writer, whose line
separator is the record separator, so the files are plain ``WARC/1.0`` on whatever store holds the
path.  Pages of over ``LARGE_BYTES`` lie in files of their own, so that every file's size is bounded by
its number of records.  Reading back parses the files, checks every payload against its digest and
notes each record's file, offset and length.

The index sorts captures by reversed-host URL key into compressed blocks, which lie one after the other
in index files.  A sparse directory holds each block's first and last key and its place (file, offset,
length); it is sorted and cut into parts of at most ``PART_BLOCKS`` blocks, and a root has one row for
each part.  A lookup bisects the root, reads the parts that may hold the key and bisects them, reads the
byte ranges of those blocks, bisects a block's lines, and reads the byte range of the record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import unquote_plus, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace.llm.common import checkpoint

#: Records of a file, captures of an index block, blocks of an index file and of a directory part.
RECORDS_PER_FILE = 4096
BLOCK_LINES = 2048
BLOCKS_PER_FILE = 256
PART_BLOCKS = 65_536
#: Pages of more bytes are written apart, as many to a file as keep it under FILE_BYTES, one at least.
LARGE_BYTES, FILE_BYTES = 32 << 10, 128 << 20
#: Up to so many repeated payloads (some 10 MB) the table of their first ids is broadcast; above, joined by shuffle.
BROADCAST_ROWS = 100_000
#: Payloads of at least so many bytes are written once.
REVISIT_FROM_BYTES = 0
_CRLF = "\r\n"
_END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"

#: A capture's fields; ids as text, as they stand in the archives.
_TEXTUAL = (
    "key string, page_id string, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to string, file string, offset long, length long"
)
_DIRECTORY = ["first_key", "last_key", "file", "offset", "length"]


def surt(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query; the scheme, port, user and fragment go."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
    except ValueError:
        return (url or "").strip()
    labels = ",".join(reversed(host.rstrip(".").split("."))) if host else ""
    return f"{labels}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a 160-bit hexadecimal digest: five hex digits are four base32 ones."""
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_FROM_BYTES) -> DataFrame:
    """One column ``record`` per page: a response, or a revisit of the equal payload with the least id.

    A null payload is empty; a null URL is written as about:blank; line ends in a URL are escaped, ids
    are written as text, URL-encoded.  Rows that repeat a page id and its payload are all responses if
    that id is the least.  A null id never is the least where another exists.  The column ``n`` has the
    payload's bytes.
    """
    page = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).withColumns({"sha": F.sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html").cast("long")})
    first = page.filter(F.col("n") >= least).groupBy("sha", "n").agg(F.min("id").alias("first"), F.count("*").alias("c"))
    repeated = checkpoint(first.filter("c > 1").drop("c"))
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if small:
        both = page.join(F.broadcast(repeated), ["sha", "n"], "left")
    else:
        # A payload that a third of all pages share meets its first id without the pages' bodies.
        named = page.select("id", "sha", "n").distinct().join(repeated, ["sha", "n"]).select(F.col("id").alias("_id"), F.col("sha").alias("_sha"), "first")
        both = page.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("n").cast("string"), F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page"), F.coalesce(F.concat(F.lit(":"), F.url_encode(c.cast("string"))), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.0{_CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{_CRLF}WARC-Record-ID: "), name(F.col("id")),
        F.lit(f"{_CRLF}WARC-Date: {DATE}{_CRLF}WARC-Target-URI: "), uri,
        F.lit(f"{_CRLF}Content-Type: application/http; msgtype=response{_CRLF}WARC-Payload-Digest: sha1:"),
        base32_of_hex(F.col("sha")),
        F.when(revisit, F.concat(F.lit(f"{_CRLF}WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest{_CRLF}WARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{_CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END),
    )
    return both.select(F.concat(head, block).alias("record"), "n")


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """Write ``records`` as WARC files into the new folders ``path``/pages and, if there are any, ``path``/large."""
    made = records(pages, **columns)
    html = F.octet_length(columns.get("html_col", "html"))
    most = pages.agg(F.max(html)).first()[0] or 0
    folders = {"pages": (F.col("n") <= LARGE_BYTES, RECORDS_PER_FILE)}
    if most > LARGE_BYTES:
        folders["large"] = (F.col("n") > LARGE_BYTES, min(RECORDS_PER_FILE, max(1, FILE_BYTES // (most + 4096))))
    for folder, (mine, rows) in folders.items():
        some = made.filter(mine).select("record")
        some.write.option("lineSep", _END).option("maxRecordsPerFile", rows).mode("errorifexists").text(f"{path}/{folder}")


class WarcError(ValueError):
    """A record that is not well formed or whose payload does not match its digest."""


def parse(data: bytes | memoryview, at: int = 0, end: int | None = None) -> Iterator[tuple[int, int, dict[str, str], bytes, bytes]]:
    """(offset, length, headers, HTTP head, payload) of every record in the bytes."""
    data, end = bytes(data), len(data) if end is None else end
    while at < end:
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.0\r\n", at) or stop < 0:
            raise WarcError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in data[at:stop].decode("utf-8").split(_CRLF)[1:])
        start = stop + 4
        close = start + int(headers["Content-Length"])
        if data[close : close + 4] != b"\r\n\r\n":
            raise WarcError(f"the record at byte {at} is cut off")
        head, _, payload = data[start:close].partition(b"\r\n\r\n")
        yield at, close + 4 - at, headers, head, payload
        at = close + 4


def _page(name: str | None) -> str | None:
    return unquote_plus(name[len("<urn:page:") : -1]) if name and name != "<urn:page>" else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the written files below ``path``; none where nothing was written."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.filter(~F.col("path").rlike("/[_.][^/]*$")).select("path", "content")


def captures(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per record of the archives under ``path``, read back from their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows = batch.column(0)[i].as_py(), []
                for at, length, headers, head, payload in parse(batch.column(1)[i].as_buffer()):
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
                    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise WarcError(f"{file} at byte {at}: the payload does not match its digest")
                    ids = [_page(headers.get(h)) for h in ("WARC-Record-ID", "WARC-Refers-To")]
                    url = headers["WARC-Target-URI"]
                    rows.append((surt(url), ids[0], url, kind, size, digest, ids[1], file, at, length))
                yield _captured(rows)

    return _typed(_files(spark, path).mapInArrow(run, _TEXTUAL), id_type)


def _captured(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in _TEXTUAL.split(", ")), strict=True)
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(cols, kinds, strict=True)], list(names))


def _typed(found: DataFrame, id_type: str) -> DataFrame:
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def write_index(found: DataFrame, path: str) -> None:
    """Sort captures by key into compressed blocks in the files of ``path``/blocks; write ``path``/directory and ``path``/root.

    A block is a line of base64, so that its place follows from the lines before it.  Captures of one key
    may span blocks.  The range sort has the page id and place behind the key, so a key that many captures
    share is split like any other.
    """
    order = ["key", "page_id", "file", "offset"]
    fields = [c.split()[0] for c in _TEXTUAL.split(", ")]
    lines_of_block = BLOCK_LINES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([base64.b64encode(zlib.compress("\n".join(lines).encode(), 6)).decode()])], ["value"])

        for batch in batches:
            for row in batch.to_pylist():
                lines.append(json.dumps([row[f] for f in fields], ensure_ascii=False))
                if len(lines) == lines_of_block:
                    yield block()
                    lines = []
        if lines:
            yield block()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, at, rows = batch.column(0)[i].as_py(), 0, []
                for line in batch.column(1)[i].as_py().split(b"\n")[:-1]:
                    keys = [x[0] for x in _lines(line)]
                    rows.append((keys[0], keys[-1], file, at, len(line)))
                    at += len(line) + 1
                cols = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [*[pa.string()] * 3, *[pa.int64()] * 2], strict=True)], _DIRECTORY)

    spark = found.sparkSession
    sorted_ = found.repartitionByRange(*order).sortWithinPartitions(*order)
    written = sorted_.select(*[F.col(f).cast("string") if f in ("page_id", "refers_to") else f for f in fields]).mapInArrow(pack, "value string")
    written.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/blocks")
    # Base64 keeps line ends out of a block; the directory is read back from the files themselves.
    places = _files(spark, f"{path}/blocks").mapInArrow(place, "first_key string, last_key string, file string, offset long, length long")
    parts = places.repartitionByRange("first_key", "file", "offset").sortWithinPartitions("first_key", "file", "offset")
    parts.select(F.to_json(F.array(*[F.col(c).cast("string") for c in _DIRECTORY])).alias("value")).write.option("maxRecordsPerFile", PART_BLOCKS).text(f"{path}/directory")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if rows := _part(batch.column(1)[i].as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (rows[0][0], max(r[1] for r in rows), batch.column(0)[i].as_py())], ["first_key", "last_key", "file"])

    _files(spark, f"{path}/directory").mapInArrow(ends, "first_key string, last_key string, file string").write.parquet(f"{path}/root")


def _lines(block: bytes) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(base64.b64decode(block)).decode("utf-8").split("\n")]


def _part(data: bytes) -> list[tuple[str, str, str, int, int]]:
    return [(a, b, f, int(o), int(n)) for a, b, f, o, n in map(json.loads, data.decode("utf-8").split("\n")[:-1])]


def read_index(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """All captures, decoded from the index blocks at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0).to_pylist():
                yield _captured([tuple(x) for x in _lines(body.encode())])

    return _typed(spark.read.schema("value string").text(f"{path}/blocks").mapInArrow(run, _TEXTUAL), id_type)


class CaptureIndex:
    """Lookups by URL: bisect the root, a directory part and a block, then read a byte range of an archive.

    Only the root is held, one row for each ``PART_BLOCKS`` blocks; ``bytes_read`` counts what lookups read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.bytes_read = spark, 0
        self.fields = [c.split()[0] for c in _TEXTUAL.split(", ")]
        rows = spark.read.schema("first_key string, last_key string, file string").parquet(f"{path}/root").collect()
        self.root = sorted((r["first_key"], r["last_key"], r["file"]) for r in rows)

    def _bytes(self, file: str, offset: int = 0, length: int | None = None) -> bytes:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(file)
        store = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        length = store.getFileStatus(where).getLen() if length is None else length
        stream = store.open(where)
        try:
            stream.seek(offset)
            data = bytes(stream.readNBytes(length))
        finally:
            stream.close()
        self.bytes_read += len(data)
        return data

    @staticmethod
    def _around(rows: list[tuple], key: str) -> list[tuple]:
        """Of rows (first_key, last_key, ...) sorted by first_key, those that may hold the key."""
        first = [r[0] for r in rows]
        return [r for r in rows[max(bisect_left(first, key) - 1, 0) : bisect_right(first, key)] if r[1] >= key]

    def lookup(self, url: str) -> list[dict]:
        """Captures whose key equals the URL's, in index order, ids as text; an unknown URL has none."""
        key, out = surt(url), []
        for _, _, part in self._around(self.root, key):
            for _, _, file, offset, length in self._around(_part(self._bytes(part)), key):
                lines = _lines(self._bytes(file, offset, length))
                keys = [x[0] for x in lines]
                out += [dict(zip(self.fields, x, strict=True)) for x in lines[bisect_left(keys, key) : bisect_right(keys, key)]]
        return out

    def read(self, capture: dict) -> tuple[dict[str, str], bytes]:
        """(headers, payload) of a capture, from its byte range alone."""
        _, _, headers, _, payload = next(parse(self._bytes(capture["file"], capture["offset"], capture["length"])))
        return headers, payload


def fetch(found: DataFrame, path: str) -> DataFrame:
    """(file, offset, length, payload_bytes, payload_digest) of captures, each from the byte range that the index gives it.

    The ranges are gathered by file (a file's records are bounded), each file is read once and nothing in
    it but the ranges is looked at.  Ranges that do not hold one whole record raise WarcError.
    """
    spark = found.sparkSession
    ranges = checkpoint(found.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges")))
    small = found.count() <= BROADCAST_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, data, rows = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer()), []
                for r in batch.column(2)[i].as_py():
                    whole = list(parse(data[r["offset"] : r["offset"] + r["length"]]))
                    if len(whole) != 1:
                        raise WarcError(f"{file} at byte {r['offset']}: not one record")
                    payload = whole[0][4]
                    rows.append((file, r["offset"], r["length"], len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()))
                kinds = [pa.string(), *[pa.int64()] * 3, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "offset", "length", "payload_bytes", "payload_digest"])

    files = _files(spark, path)
    wanted = F.broadcast(ranges) if small else ranges
    both = files.join(wanted, files["path"] == wanted["file"]).select("path", "content", "ranges")
    return both.mapInArrow(run, "file string, offset long, length long, payload_bytes long, payload_digest string")


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_FROM_BYTES) -> DataFrame:
    """Write pages under ``path``, read them back, index them; the captures as the index gives them.

    Payload sizes and digests of responses are those of the bytes in the range that the index has for
    them; those of revisits are of the full payload, from their headers.
    """
    spark, kind = pages.sparkSession, dict(pages.dtypes)[id_col]
    write_archives(pages, f"{path}/archives", id_col=id_col, url_col=url_col, html_col=html_col, least=least)
    write_index(checkpoint(captures(spark, f"{path}/archives", kind)), f"{path}/index")
    found = checkpoint(read_index(spark, f"{path}/index", kind))
    read = fetch(found.filter("record_type = 'response'"), f"{path}/archives")
    whole = found.filter("record_type = 'response'").drop("payload_bytes", "payload_digest").join(read, ["file", "offset", "length"], "left")
    return whole.select(found.columns).unionByName(found.filter("record_type <> 'response'"))
