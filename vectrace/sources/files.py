"""Readers: sidecar tables and documents, trees of them, manifests, bundles, lists, SQLite databases.

Everything goes through Spark's own file access, so any store that Spark reads will do; Python only
decodes bytes that Spark has read.
"""

from __future__ import annotations

import gzip
import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vectrace import schemas
from vectrace.functions.exprs import basename, null_if_nan, parent

_HEADER = struct.Struct("<8s6I")
_ENDIAN = 0x01020304
#: pts of a frame without a time stamp.
NO_PTS = -(1 << 63)
#: Bytes of a stream up to which Spark reads its file in one piece, and records of a stream that are decoded at a time.
WHOLE_BYTES, CHUNK_ROWS = 1 << 24, 1 << 16


class FormatError(ValueError):
    """A file is not in the format it should be in."""


def read_csv(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Vector or frame tables in (gzip) CSV, with their fixed types; the header must match; NaN is null."""
    schema = schemas.BINARY[kind][2]
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*[null_if_nan(f.name).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name) for f in schema])


def store_of(path: str):
    """(file system, path on it) as pyarrow names them; a path without a store is a local one."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:(//)?(?=/)", "", path)


def stream_records(file, kind: str, name: str = "stream", rows: int = CHUNK_ROWS) -> Iterator[np.ndarray]:
    """Records of a seekable binary stream, gzipped (in any number of members) or not, so many at a time as structured arrays; every header field is checked."""
    magic, code, schema = schemas.BINARY[kind]
    zipped = file.read(2) == b"\x1f\x8b"
    file.seek(0)
    data = gzip.GzipFile(fileobj=file) if zipped else file
    head, record = data.read(_HEADER.size), struct.calcsize(code)
    if len(head) < _HEADER.size:
        raise FormatError(f"{name}: the header is cut off")
    want = (magic, 1, _ENDIAN, _HEADER.size, record, len(schema), 0)
    if _HEADER.unpack(head) != want:
        raise FormatError(f"{name}: unexpected header {_HEADER.unpack(head)}")
    kinds = np.dtype(list(zip(schema.names, schemas.record_types(kind), strict=True)))
    while part := data.read(rows * record):
        if len(part) % record:
            raise FormatError(f"{name}: the last record is cut off")
        yield np.frombuffer(part, dtype=kinds)


def decode_binary(data: bytes, kind: str, name: str = "stream") -> np.ndarray:
    """All records of a binary stream, gzipped or not, as a structured array; every header field is checked."""
    kinds = np.dtype(list(zip(schemas.BINARY[kind][2].names, schemas.record_types(kind), strict=True)))
    return np.concatenate([np.zeros(0, dtype=kinds), *stream_records(io.BytesIO(data), kind, name)])


def read_binary(spark: SparkSession, path: str, kind: str, frames: tuple[int, int] | None = None, source: str = "all") -> DataFrame:
    """Vector or frame tables in the fixed-width format, with the file's path as ``_file``.

    ``frames`` (first, last) and ``source`` (all, past, future) are applied to the records before
    they become rows.  A missing pts is null, and so is the time of such a row.  Files of up to
    WHOLE_BYTES are read by Spark; longer ones are streamed by their task from a store that pyarrow
    reaches, so a task holds CHUNK_ROWS records, however long its file is.
    """
    schema = T.StructType([*schemas.BINARY[kind][2], T.StructField("_file", T.StringType())])
    arrow = to_arrow_schema(schema)

    def decoded(content: io.BytesIO, file: str) -> Iterator[pa.RecordBatch]:
        for rows in stream_records(content, kind, file):
            if frames:
                rows = rows[(rows["frame_index"] >= frames[0]) & (rows["frame_index"] <= frames[1])]
            if source != "all":
                rows = rows[rows["source"] < 0 if source == "past" else rows["source"] > 0]
            cols = []
            absent = rows["pts"] == NO_PTS
            for f in list(arrow)[:-1]:
                values = rows[f.name].astype(f.type.to_pandas_dtype())
                mask = absent if f.name in ("pts", "time_seconds") else None
                if pa.types.is_floating(f.type):
                    mask = np.isnan(values) if mask is None else mask | np.isnan(values)
                cols.append(pa.array(values, f.type, mask=mask))
            yield pa.RecordBatch.from_arrays([*cols, pa.array([file] * len(rows), pa.string())], schema=arrow)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from decoded(io.BytesIO(content.as_buffer()), file)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, at = store_of(file)
                with store.open_input_file(at) as content:
                    yield from decoded(content, file)

    found = spark.read.format("binaryFile").load(path)
    short = found.filter(F.col("length") <= WHOLE_BYTES).select("path", "content").mapInArrow(whole, schema)
    return short.unionAll(found.filter(F.col("length") > WHOLE_BYTES).select("path").mapInArrow(streamed, schema))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schemas.METADATA).json(path).withColumn("_file", F.col("_metadata.file_path"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, folder, name) of every file under ``root``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return files.withColumns({"folder": parent("path"), "name": basename("path")})


def discover(spark: SparkSession, root: str) -> DataFrame:
    """One row per frame table under ``root``: stem, folder, frames, vectors (CSV before binary), metadata, missing."""
    part = F.regexp_extract("name", r"^(.*?)\.?(frames\.csv\.gz|frames\.bin\.gz|vectors\.csv\.gz|vectors\.bin\.gz|metadata\.json)$", 2)
    stem = F.regexp_extract("name", r"^(.*?)\.?(?:frames|vectors|metadata)\.(?:csv\.gz|bin\.gz|json)$", 1)
    named = list_files(spark, root).withColumns({"part": part, "stem": stem}).filter("part <> ''")
    of = lambda p: F.max(F.when(F.col("part") == p, F.col("path")))
    sets = named.groupBy("folder", "stem").agg(
        F.coalesce(of("frames.csv.gz"), of("frames.bin.gz")).alias("frames"),
        F.coalesce(of("vectors.csv.gz"), of("vectors.bin.gz")).alias("vectors"), of("metadata.json").alias("metadata"),
    )
    return sets.filter("frames is not null").withColumn("missing", F.when(F.col("vectors").isNull(), "vectors"))


def read_comparisons(spark: SparkSession, root: str, schema: T.StructType | str, name: str = "all_wells_comparison.csv") -> DataFrame:
    """The comparison tables of all videos in the given types, the video taken from the folder; none at all is an error.

    Each file's header must name the schema's columns in their order.
    """
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(f"{root.rstrip('/')}/*/{name}")
    return df.withColumn("video", basename(parent(F.col("_metadata.file_path"))))


def read_manifest(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV table with every column as text; ``required`` columns must be there."""
    df = spark.read.option("header", True).option("inferSchema", False).option("nullValue", "\x00").option("emptyValue", "").csv(path)
    schemas.require(required, df.columns, path)
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(input_path): the lines of a text file without blank ones and comments."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("input_path")).filter((F.col("input_path") != "") & ~F.col("input_path").startswith("#"))


def list_videos(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("mkv", "mp4", "avi", "mov")) -> DataFrame:
    """(input_path) of files with one of the extensions, in any case."""
    suffix = F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))
    return list_files(spark, root).filter(suffix.isin(*extensions)).select(F.col("path").alias("input_path"))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where))


def read_bundle(spark: SparkSession, folder: str, table: str, required: bool = True) -> DataFrame | None:
    """A bundle's table as Parquet where there is one, else as CSV; a missing optional one is None."""
    for path, read in ((f"{folder}/{table}.parquet", spark.read.parquet), (f"{folder}/{table}.csv", lambda p: read_manifest(spark, p))):
        if _exists(spark, path):
            return read(path)
    if required:
        raise FileNotFoundError(f"{folder} has no {table} table")
    return None


def read_sqlite(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Columns of a table of a SQLite file, as text; a table or column that is not there is an error.

    The file's bytes are opened in memory, read only, by the one task that read them.
    """
    import re

    if not all(re.fullmatch(r"\w+", n) for n in [table, *columns]):
        raise ValueError("table and column names are letters, digits and underscores")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sqlite3

        for batch in batches:
            for content in batch.column(0):
                with sqlite3.connect(":memory:") as db:
                    db.deserialize(content.as_buffer().to_pybytes())
                    have = {r[1] for r in db.execute(f"pragma table_info({table})")}
                    schemas.require(columns, sorted(have), table)
                    cursor = db.execute(f"select {', '.join(columns)} from {table}")
                    while rows := cursor.fetchmany(4096):
                        cols = [pa.array([None if r[i] is None else str(r[i]) for r in rows], pa.string()) for i in range(len(columns))]
                        yield pa.RecordBatch.from_arrays(cols, columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"{c} string" for c in columns))


def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, sha256) of the files at ``root``."""
    return spark.read.format("binaryFile").load(root).select("path", "length", F.sha2("content", 256).alias("sha256"))
