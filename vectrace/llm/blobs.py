"""Packed arrays dealt between buckets and units of a corpus.

A unit is a run of texts of one partition.  Work on tokens is done inside units and buckets by array
operations; what passes between them is one row of packed arrays for each unit and bucket, so that a
shuffle moves bytes and not rows.  Units are read again later, so the input must be cut the same way.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vectrace.llm.common import delete_folder, shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SPLITS = "spark.sql.files.minPartitionNum"

#: What a row is, the bucket or unit it goes to, the unit or bucket it comes from, packed arrays, two sums.
ROWS = "kind int, key long, origin long, body binary, a long, b long"
Row = tuple[int, int, int, bytes | None, int, int]
Held = dict[int, list[tuple[int, bytes]]]


@contextmanager
def same_cuts(spark: SparkSession) -> Iterator[None]:
    """Files are cut into partitions alike while this holds, whatever executors come or go."""
    splits = spark.conf.get(_SPLITS, None)
    if splits is None:
        spark.conf.set(_SPLITS, max(1, spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if splits is None:
            spark.conf.unset(_SPLITS)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each with its type and length."""
    heads = [struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)) for a in arrays]
    return b"".join([struct.pack("<B", len(arrays)), *heads, *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(body: bytes) -> list[np.ndarray]:
    at, out = 1 + 10 * body[0], []
    for i in range(body[0]):
        kind, n = struct.unpack_from("<2sQ", body, 1 + 10 * i)
        out.append(np.frombuffer(body, dtype=np.dtype(f"<{kind.decode()}"), count=n, offset=at))
        at += out[-1].nbytes
    return out


@lru_cache(maxsize=1)
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(data: np.ndarray) -> np.ndarray:
    """Bytes, compressed."""
    return np.frombuffer(_zstd()[0].compress(data.tobytes()), dtype=np.uint8)


def loosen(body: np.ndarray) -> np.ndarray:
    return np.frombuffer(_zstd()[1].decompress(body.tobytes()), dtype=np.uint8)


def press(numbers: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits, byte place by byte place, compressed: small numbers leave whole places empty."""
    places = np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)
    return squeeze(places)


def unpress(body: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(loosen(body).reshape(4, -1).T).view(np.uint32).reshape(-1)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(x, return_inverse=True)
    return values, at.reshape(-1)


def bucket_of(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each code, rising with the code."""
    return ((code >> np.uint64(31)) * np.uint64(buckets)) >> np.uint64(32)


def cut(code: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of ascending codes."""
    at = bucket_of(code, buckets)
    edges = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.empty(0, dtype=np.int64)
    yield from zip(at[edges].tolist(), edges.tolist(), np.append(edges, len(at))[1:].tolist(), strict=True)


def batch_of(rows: list[Row]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    cols = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["kind", "key", "origin", "body", "a", "b"])


def by_key(df: DataFrame, make: Callable[[int, Held], Iterator[Row]], tasks: int) -> DataFrame:
    """Rows that ``make`` gives for each key from its rows by kind, each kind's (origin, body) ascending by origin.

    Each key from 0 to ``tasks`` (from the other end, if negative) is a task of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            kinds, keys, origins = (batch.column(i).to_pylist() for i in range(3))
            for i, key in enumerate(keys):
                if key != now:
                    if held:
                        yield batch_of(list(make(now, held)))
                    now, held = key, {}
                held.setdefault(kinds[i], []).append((origins[i], batch.column(3)[i].as_py()))
        if held:
            yield batch_of(list(make(now, held)))

    own = df.select("kind", "key", "origin", "body").repartitionById(tasks, F.pmod("key", F.lit(tasks)).cast("int"))
    return own.sortWithinPartitions("key", "kind", "origin").mapInArrow(run, ROWS)


def by_unit(df: DataFrame, make: Callable[[Held], Iterator[pa.RecordBatch]], schema: str, tasks: int) -> DataFrame:
    """What ``make`` gives for each unit from the rows that go to it, dealt to some ``tasks`` tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            kinds, keys, origins = (batch.column(i).to_pylist() for i in range(3))
            for i, key in enumerate(keys):
                if key != now:
                    if held:
                        yield from make(held)
                    now, held = key, {}
                held.setdefault(kinds[i], []).append((origins[i], batch.column(3)[i].as_py()))
        if held:
            yield from make(held)

    own = df.select("kind", "key", "origin", "body").repartition(tasks, "key")
    return own.sortWithinPartitions("key", "kind", "origin").mapInArrow(run, schema)


class Store:
    """Tables of rows in a shared folder; shuffle files behind them are given back when they are written."""

    def __init__(self, spark: SparkSession, name: str, schema: str = ROWS):
        self.spark, self.top, self.schema = spark, shared_folder(spark, name), schema

    def write(self, df: DataFrame, name: str, by_kind: bool = True) -> None:
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            # Rows of megabytes: sizes are looked at row by row, so that little is held.
            writer = df.write.option("parquet.block.size", 32 << 20).option("parquet.enable.dictionary", "false")
            for check in ("parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
                writer = writer.option(check, 1)
            (writer.partitionBy("kind") if by_kind else writer).parquet(f"{self.top}/{name}")
        finally:
            self.spark.conf.set(_CLEANUP, before)

    def read(self, name: str, *kinds: int) -> DataFrame:
        found = self.spark.read.schema(self.schema).parquet(f"{self.top}/{name}").filter(F.col("kind").isin(*kinds))
        return found.select("kind", "key", "origin", "body", "a", "b")

    def whole(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.top}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.top}/{name}")
