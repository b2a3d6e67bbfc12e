"""Writers: compatible CSV, fixed-width streams, reports, metadata documents."""

from __future__ import annotations

import gzip
import struct
import subprocess
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from vectrace import schemas
from vectrace.functions.exprs import in_range
from vectrace.session import checkpointed
from vectrace.sources.files import store_of

_HEADER = struct.Struct("<8s6I")
#: Rows of a range of frames, which becomes a gzip member; rows that a task deals out at a time; ranges of a stream at most.
MEMBER_ROWS, DEALT_ROWS, MOST_RANGES = 1 << 17, 1 << 18, 1024


def significant(column: str, digits: int = 6):
    """A double as text with so many significant digits, as C's %g writes it; null is empty.

    Java's %g neither drops zeros nor switches notation where C does, so both are done here.  A tie in
    the shortest decimal form rounds up, where C looks at the binary value.
    """
    in_range("digits", digits, 1, 17)
    x = F.col(column).cast("double")
    science = F.format_string(f"%.{digits - 1}e", x)
    power = F.regexp_extract(science, r"e([+-]\d+)$", 1).cast("int")
    digit = F.regexp_extract(science, r"^(.*)e", 1)
    mantissa = F.regexp_replace(digit, r"\.?0+$", "") if digits > 1 else digit
    fixed = F.lit(None).cast("string")
    for p in range(-4, digits):
        places = digits - 1 - p
        text = F.format_string(f"%.{places}f", x)
        text = F.regexp_replace(text, r"\.?0+$", "") if places else text
        fixed = F.when(power == p, text).otherwise(fixed)
    return F.when(x.isNull(), F.lit("")).when(x == 0, F.lit("0")).otherwise(F.coalesce(fixed, F.concat(mantissa, F.lit("e"), F.format_string("%+03d", power))))


def write_csv(df: DataFrame, path: str, kind: str, digits: int | None = 6, overwrite: bool = False) -> None:
    """A vector or frame table as gzip CSV in file order of columns; frame doubles with ``digits`` significant digits."""
    schema = schemas.BINARY[kind][2]
    schemas.require(schema.names, df.columns, kind)
    doubles = {f.name for f in schema if f.dataType.simpleString() == "double"}
    text = lambda c: significant(c, digits) if kind == "frames" and digits else F.format_string("%.9f", F.col(c))
    out = df.select(*[(F.when(F.col(c).isNotNull(), text(c)).otherwise(F.lit("")) if c in doubles else F.col(c)).alias(c) for c in schema.names])
    out.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("compression", "gzip").option("emptyValue", "").csv(path)


def _first_frames(df: DataFrame, keys: list[str]) -> dict[int, np.ndarray]:
    """Ascending frames at which a stream's second and later ranges begin, by the hash of its key; streams of one range are left out.

    Quantiles good to a part in 10,000: they balance the ranges, and any cuts give the same stream.
    """
    steps = F.array(*[F.lit(i / MOST_RANGES) for i in range(1, MOST_RANGES)])
    sizes = df.groupBy(F.xxhash64(*keys).alias("key")).agg(F.count("*").alias("n"), F.percentile_approx(F.coalesce("frame_index", F.lit(0)), steps, 10_000).alias("q"))
    ranges = F.least(F.lit(MOST_RANGES), F.ceil(F.col("n") / MEMBER_ROWS))
    begins = lambda i: F.floor((i + 1) * ranges / MOST_RANGES) > F.floor(i * ranges / MOST_RANGES)
    cuts = sizes.filter(ranges > 1).select("key", F.filter("q", lambda _, i: begins(i)).alias("cuts"))
    return {r["key"]: np.array(r["cuts"]) for r in cuts.collect()}  # a number for each MEMBER_ROWS rows


def binary_streams(df: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """(keys, part, content): one gzipped fixed-width stream per key, frames in order, in parts to be appended.

    A key is one file of the format, so one task builds it; its rows come in order and its parts count from 0.
    A part is a gzip member of one range of frames (MEMBER_ROWS rows, and all of its last frame), the most
    that a task holds.  Rows travel as packed records, in runs by range, each column of a run by itself.
    """
    magic, code, schema = schemas.BINARY[kind]
    head = _HEADER.pack(magic, 1, 0x01020304, _HEADER.size, struct.calcsize(code), len(schema), 0)
    record = np.dtype(list(zip(schema.names, schemas.record_types(kind), strict=True)))
    doubles = {f.name for f in schema if record[f.name].kind == "f"}
    order = [c for c in ("vector_index", "frame_index") if c in schema.names]
    rows = df.select(*keys, F.xxhash64(*keys).alias("_key"), *[F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in schema.names])
    firsts = _first_frames(df, keys)
    dealt = df.select(*keys).limit(0).select("*", F.lit(0).alias("_range"), F.lit(b"").alias("_run")).schema
    built = df.select(*keys).limit(0).select("*", F.lit(0).alias("part"), F.lit(b"").alias("content")).schema
    deal_as, build_as = to_arrow_schema(dealt), to_arrow_schema(built)

    def plain(name: str, column: pa.Array) -> np.ndarray:
        missing = -(1 << 63) if name == "pts" else float("nan") if name in doubles else 0
        values = (pc.fill_null(column, missing) if column.null_count else column).to_numpy(zero_copy_only=False)
        if values.dtype.kind == "f" and name not in doubles and np.isnan(values).any():
            return np.where(np.isnan(values), missing, values.astype(record[name]))
        return values.astype(record[name])

    def runs(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Packed records of the batches' rows, a row for each key and range."""
        table = pa.Table.from_batches(batches).combine_chunks()
        group = np.zeros(len(table), dtype=np.int64)
        for k in range(len(keys)):
            codes = table.column(k).chunk(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            _, group = np.unique(group * (int(codes.max()) + 1) + codes, return_inverse=True)
        packed = {c: plain(c, table.column(c).chunk(0)) for c in schema.names}
        at = np.lexsort((*[packed[c] for c in order], group))
        group, packed = group[at], {c: v[at] for c, v in packed.items()}
        place, number, made = [], [], []
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        hashes = table.column("_key").chunk(0).to_numpy()[at]
        for a, b in zip(edges, edges[1:], strict=False):
            cuts = a + np.searchsorted(packed["frame_index"][a:b], firsts.get(int(hashes[a]), ()))
            ends = [a, *cuts.tolist(), b]
            for i, (c, d) in enumerate(zip(ends, ends[1:], strict=False)):
                if c < d:
                    place.append(at[c])
                    number.append(i)
                    made.append(zlib.compress(b"".join(v[c:d].tobytes() for v in packed.values()), 1))
        own = table.select(range(len(keys))).take(pa.array(place)).combine_chunks()
        cols = [own.column(k).chunk(0) for k in range(len(keys))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(number, pa.int32()), pa.array(made, pa.binary())], schema=deal_as)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= DEALT_ROWS:
                yield runs(held)
                held, n = [], 0
        if held:
            yield runs(held)

    def records(run: bytes) -> np.ndarray:
        data = zlib.decompress(run)
        out = np.empty(len(data) // record.itemsize, dtype=record)
        at = 0
        for c in schema.names:
            out[c] = np.frombuffer(data, dtype=record[c], count=len(out), offset=at)
            at += len(out) * record[c].itemsize
        return out

    def member(own: list[pa.Array], part: int, held: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(held)
        every = every[np.lexsort([every[c] for c in order])]
        content = gzip.compress(every.tobytes() if part else head + every.tobytes(), 6, mtime=0)
        return pa.RecordBatch.from_arrays([*own, pa.array([part], pa.int32()), pa.array([content], pa.binary())], schema=build_as)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, own, part = [], None, [], 0
        for batch in batches:
            names = list(zip(*[batch.column(k).to_pylist() for k in range(len(keys))], batch.column(len(keys)).to_pylist(), strict=True))
            for i, name in enumerate(names):
                if now is not None and name != now:
                    yield member(own, part, held)
                    part = part + 1 if name[:-1] == now[:-1] else 0
                    held = []
                if not held:
                    now, own = name, [pa.concat_arrays([batch.column(k).slice(i, 1)]) for k in range(len(keys))]
                held.append(records(batch.column(len(keys) + 1)[i].as_py()))
        if held:
            yield member(own, part, held)

    return rows.mapInArrow(deal, dealt).repartition(*keys).sortWithinPartitions(*keys, "_range").mapInArrow(build, built)


def save_streams(streams: DataFrame, folder: str, name: str) -> DataFrame:
    """Write each stream's content to ``folder``/<value of ``name``> on any store pyarrow reaches; (file, bytes) rows.

    A stream in parts, as ``binary_streams`` gives them, is appended part by part.  A file is written under
    another name and then moved, so a task that is run again replaces it whole.
    """
    parted = "part" in streams.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = store_of(folder)
        store.create_dir(top, recursive=True)
        out, now, last, size = None, None, -1, 0

        def finished() -> pd.DataFrame:
            out.close()
            store.move(f"{top}/.{now}.partial", f"{top}/{now}")
            return pd.DataFrame([(now, size)], columns=["file", "bytes"])

        for part in parts:
            for file, content, number in zip(part[name], part["content"], part["part"] if parted else [0] * len(part), strict=True):
                if not number:
                    if out:
                        yield finished()
                    out, now, last, size = store.open_output_stream(f"{top}/.{file}.partial", compression=None), file, -1, 0
                if (file, number) != (now, last + 1):
                    raise ValueError(f"part {number} of {file} does not follow part {last} of {now}")
                out.write(content)
                last, size = number, size + len(content)
        if out:
            yield finished()

    return streams.select(name, "content", *["part"] * parted).mapInPandas(run, "file string, bytes long")


def write_report(df: DataFrame, path: str, separator: str = ",", overwrite: bool = False) -> None:
    """A report table as text; nulls are empty."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("sep", separator).option("emptyValue", "").csv(path)


def write_features(df: DataFrame, path: str, by: tuple[str, ...] = (), overwrite: bool = False) -> None:
    """Derived features as Parquet in folders by the given columns."""
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*by).parquet(path)


def metadata(counters: DataFrame, hashes: DataFrame, **fields: str) -> DataFrame:
    """One JSON document: format fields, row counts and the hash of every output file."""
    files = hashes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "sha256")))).alias("outputs"))  # files of one sidecar
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    both = counters.crossJoin(F.broadcast(files))
    return both.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()], *counters.columns, now.alias("created_at"), "outputs")).alias("json"))


def numbered(df: DataFrame, name: str, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """df with a number from 1 in ``order`` within ``keys``; without keys over the whole table.

    The whole table is sorted by ranges; a range's rows are numbered from the rows of those before it,
    so no task holds more than its range.  The sorted rows are written once and read twice.
    """
    if keys:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    ranged = checkpointed(df.sort(*order)).withColumn("_place", F.monotonically_increasing_id())
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()  # one row a partition
    first, before = [], 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        first.append((r["_part"], before))
        before += r["_n"]
    starts = df.sparkSession.createDataFrame(first, "_part long, _first long")
    both = ranged.withColumns({"_part": part, "_inside": inside}).join(F.broadcast(starts), "_part")
    return both.withColumn(name, F.col("_first") + F.col("_inside") + 1).drop("_part", "_inside", "_place", "_first")


def provenance(folder: str) -> dict[str, str | bool | None]:
    """Commit of the working copy that holds ``folder`` and whether it has changes; nulls where there is none."""

    def git(*words: str) -> str | None:
        done = subprocess.run(["git", "-C", folder, *words], capture_output=True, text=True, timeout=30, check=False)
        return done.stdout.strip() if not done.returncode else None

    try:
        commit, changes = git("rev-parse", "HEAD"), git("status", "--porcelain")
    except (OSError, subprocess.TimeoutExpired):
        commit = changes = None
    return {"commit": commit, "modified": None if commit is None or changes is None else bool(changes)}


def manifest_document(rows: DataFrame, inputs: DataFrame, code: dict[str, str | bool | None], **fields: str) -> DataFrame:
    """One JSON document of a manifest: its rows and plates counted, its input files by hash, and the code that made it.

    ``inputs`` are (path, length, sha256) as ``file_hashes`` gives them; a document has few input files.
    """
    files = inputs.agg(F.array_sort(F.collect_list(F.struct("path", "length", "sha256"))).alias("inputs"))
    counts = rows.agg(F.count("*").alias("n_wells"), F.countDistinct("source_video_id").alias("n_plates"))
    made = F.struct(F.lit(code.get("commit")).cast("string").alias("commit"), F.lit(code.get("modified")).cast("boolean").alias("modified"))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    both = counts.crossJoin(F.broadcast(files))  # one row each
    named = [F.lit(v).alias(k) for k, v in fields.items()]
    return both.select(F.to_json(F.struct(*named, "n_wells", "n_plates", "inputs", made.alias("code"), now.alias("created_at"))).alias("json"))
