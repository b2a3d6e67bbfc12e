"""Media columns: GIF files decoded to timed frames with colour histograms.

``decode`` reads any GIF87a/89a: LZW code streams of every code size with early and deferred clears,
global and local palettes, interlacing, transparency and the four disposal rules.  Code positions
follow from the count of codes since the last clear alone, so a run of codes is unpacked at once and
only the expansion of codes to strings is stepped.  ``encode`` writes byte strings as grey frames
that give the same bytes back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectrace.llm.common import shared_folder, slices, texts

WIDTH = 64
#: Rows of a frame; a longer payload goes on in further frames.
FRAME_ROWS = 1024
#: Hundredths of a second that each written frame is shown.
DELAY = 4
HISTOGRAM_BINS = 16
#: Pixels that a file's canvas may have; a larger one is an error, whatever its header declares.
MAX_PIXELS = 1 << 26
_GREY = bytes(v for i in range(256) for v in (i, i, i))
_STRINGS = [bytes([i]) for i in range(256)]


class GifError(ValueError):
    """The bytes are not a complete, well-formed GIF."""


@dataclass
class Frame:
    index: int
    start_ms: int
    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    #: The canvas after this frame was drawn: rows x columns x RGBA.
    canvas: np.ndarray
    #: Counts of the palette's entries and the palette, where this frame hides all that was there.
    alone: tuple[np.ndarray, np.ndarray] | None = None


def _width_at(j: np.ndarray, size: int) -> np.ndarray:
    """Bits of the j-th code after a clear, where codes begin with ``size`` bits per sample."""
    free = (1 << size) + 2 + np.maximum(j - 1, 0)
    width = np.full(j.shape, size + 1)
    for bits in range(size + 1, 12):
        width += free >= 1 << bits
    return width


#: Codes from one clear to the next as ``encode`` writes them, and their widths.
_SEGMENT = 4096 - 258 + 2
_SEGMENT_WIDTHS = _width_at(np.arange(_SEGMENT), 8)


def compress(data: bytes) -> bytes:
    """LZW code stream of 8-bit samples, with a clear whenever the code table is full."""
    codes = [256]
    put = codes.append
    table: dict[int, int] = {}
    get = table.get
    free = 258
    run = -1
    for c in data:
        if run < 0:
            run = c
            continue
        key = run << 8 | c
        code = get(key)
        if code is not None:
            run = code
            continue
        put(run)
        if free < 4096:
            table[key] = free
            free += 1
        else:
            put(256)
            table.clear()
            free = 258
        run = c
    if run >= 0:
        put(run)
    put(257)
    values = np.array(codes, dtype=np.uint16)
    widths = np.concatenate(([9], np.resize(_SEGMENT_WIDTHS, len(codes) - 1)))
    bits = np.arange(12)
    flags = ((values[:, None] >> bits) & 1).astype(np.uint8)[bits < widths[:, None]]
    return np.packbits(flags, bitorder="little").tobytes()


def expand(stream: bytes, size: int, limit: int) -> bytes:
    """Samples of an LZW code stream; stops at its end code or after ``limit`` samples."""
    clear = 1 << size
    raw = np.frombuffer(stream + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    total = len(stream) * 8
    base = [*_STRINGS[:clear], b"", b""]
    out: list[bytes] = []
    made, bit, j = 0, 0, 0
    table, prev = base.copy(), b""
    while bit < total and made < limit:
        steps = np.arange(j, j + 4096)
        widths = _width_at(steps, size)
        ends = bit + np.cumsum(widths)
        n = int(np.searchsorted(ends, total, side="right"))
        if not n:
            break
        starts = (ends - widths)[:n]
        at = starts >> 3
        window = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16
        codes = (window >> (starts & 7).astype(np.uint32)) & ((1 << widths[:n]) - 1).astype(np.uint32)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        upto = int(stops[0]) if len(stops) else n
        add, put, had = table.append, out.append, len(out)
        room = 4096 - len(table)
        for code in codes[:upto].tolist():
            if prev:
                try:
                    s = table[code]
                    if room > 0:
                        add(prev + s[:1])
                        room -= 1
                except IndexError:
                    if code != len(table) or room <= 0:
                        raise GifError("code beyond the table") from None
                    s = prev + prev[:1]
                    add(s)
                    room -= 1
            else:
                if code >= len(base):
                    raise GifError("code beyond the table")
                s = table[code]
            put(s)
            prev = s
        made += sum(map(len, out[had:]))
        if not len(stops):
            bit, j = int(ends[n - 1]), j + n
            continue
        if codes[upto] == clear + 1:
            break
        bit, j = int(ends[upto]), 0
        table, prev = base.copy(), b""
    return b"".join(out)[:limit]


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while True:
        if at >= len(data):
            raise GifError("a block is cut off")
        n = data[at]
        if not n:
            return b"".join(parts), at + 1
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n


def _interlaced(rows: np.ndarray) -> np.ndarray:
    h = len(rows)
    order = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
    out = np.empty_like(rows)
    out[order] = rows
    return out


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 3 << ((flags & 7) + 1)
    if at + n > len(data):
        raise GifError("a palette is cut off")
    return np.frombuffer(data[at : at + n], dtype=np.uint8).reshape(-1, 3), at + n


def decode(data: bytes, max_pixels: int = MAX_PIXELS) -> Iterator[Frame]:
    """The frames of a GIF in order.

    Raises GifError where it is not one, is cut off, or declares a canvas or an image of over
    ``max_pixels``.  A transparent index may lie beyond the palette, a drawn one may not.
    """
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    width, height, flags = struct.unpack("<HHB", data[6:11])
    if width * height > max_pixels:
        raise GifError("the canvas is too large")
    at = 13
    shared = None
    if flags & 0x80:
        shared, at = _palette(data, at, flags)
    canvas = np.zeros((height, width, 4), dtype=np.uint8)
    delay, disposal, clear_index, index, clock = 0, 0, -1, 0, 0
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            return
        if kind == 0x21 and at + 2 < len(data):
            body, end = _blocks(data, at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, struct.unpack("<H", body[1:3])[0]
                clear_index = body[3] if body[0] & 1 else -1
            at = end
            continue
        if kind != 0x2C or at + 10 > len(data):
            raise GifError("unknown block")
        left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at += 10
        palette = shared
        if flags & 0x80:
            palette, at = _palette(data, at, flags)
        if palette is None:
            raise GifError("no palette")
        size = data[at] if at < len(data) else 0
        if not 2 <= size <= 8:
            raise GifError("bad code size")
        if w * h > max_pixels:
            raise GifError("the image is too large")
        stream, at = _blocks(data, at + 1)
        samples = np.frombuffer(expand(stream, size, w * h), dtype=np.uint8)
        if len(samples) < w * h:
            raise GifError("an image is cut off")
        counts = np.bincount(samples, minlength=256)
        drawn = counts.copy()
        if clear_index >= 0:
            drawn[clear_index] = 0
        if drawn[len(palette) :].any():
            raise GifError("sample beyond the palette")
        if len(palette) < 256:
            palette = np.concatenate((palette, np.zeros((256 - len(palette), 3), dtype=np.uint8)))
        samples = samples.reshape(h, w)
        if flags & 0x40:
            samples = _interlaced(samples)
        kept = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        shown = samples[: area.shape[0], : area.shape[1]]
        colours = np.empty((*shown.shape, 4), dtype=np.uint8)
        colours[..., :3] = palette[shown]
        colours[..., 3] = 255
        if clear_index >= 0:
            opaque = shown != clear_index
            area[opaque] = colours[opaque]
        else:
            area[...] = colours
        covers = clear_index < 0 and not left and not top and (w, h) == (width, height)
        yield Frame(index, clock * 10, delay * 10, left, top, w, h, canvas, (counts, palette) if covers else None)
        clock += delay
        if disposal == 2:
            area[...] = 0
        elif disposal == 3:
            canvas[...] = kept
        delay, disposal, clear_index, index = 0, 0, -1, index + 1
    raise GifError("no trailer")


def encode(payload: bytes) -> bytes:
    """A GIF whose grey samples, frame after frame, are the payload: a positive multiple of WIDTH bytes."""
    if not payload or len(payload) % WIDTH:
        raise ValueError(f"the payload must be a positive multiple of {WIDTH} bytes")
    rows = len(payload) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, FRAME_ROWS), 0xF7, 0, 0), _GREY]
    for top in range(0, rows, FRAME_ROWS):
        part = payload[top * WIDTH : (top + FRAME_ROWS) * WIDTH]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, DELAY, 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, WIDTH, len(part) // WIDTH, 0, 8))
        codes = compress(part)
        out += [bytes([len(b)]) + b for b in (codes[i : i + 255] for i in range(0, len(codes), 255))]
        out.append(b"\0")
    out.append(b";")
    return b"".join(out)


def histograms(frame: Frame) -> list[list[int]]:
    """Counts of red, green and blue levels in HISTOGRAM_BINS equal bins over the frame's visible canvas."""
    step = 256 // HISTOGRAM_BINS
    if frame.alone is not None:
        counts, palette = frame.alone
        return [np.bincount(palette[:, c] // step, counts, HISTOGRAM_BINS).astype(np.int64).tolist() for c in range(3)]
    seen = frame.canvas[frame.canvas[..., 3] > 0]
    return [np.bincount(seen[:, c] // step, minlength=HISTOGRAM_BINS).tolist() for c in range(3)]


def padded(text: str) -> tuple[int, bytes]:
    """Length of the text in UTF-8, and that with zero bytes up to a positive multiple of WIDTH."""
    raw = text.encode("utf-8")
    return len(raw), raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b"\0")


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every text as a GIF.  Null and empty texts are one row of zero bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [padded(t) for t in texts(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([encode(p) for _, p in made], pa.binary())],
                ["doc_id", "n_bytes", "media"],
            )

    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {dict(df.dtypes)[id_col]}, n_bytes long, media binary")


def frames(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", max_pixels: int = MAX_PIXELS) -> DataFrame:
    """One row per frame: (doc_id, frame, start_ms, delay_ms, width, height, red, green, blue, rgba, error).

    ``rgba`` is the canvas once the frame is drawn.  Media that is null, empty or broken gives one
    row with ``error`` set after the frames that could be read; nothing else fails.
    """
    schema = (
        f"doc_id {dict(df.dtypes)[id_col]}, frame int, start_ms long, delay_ms long, width int, height int, "
        "red array<long>, green array<long>, blue array<long>, rgba binary, error string"
    )
    names = ["frame", "start_ms", "delay_ms", "width", "height", "red", "green", "blue", "rgba", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.string()]

        def one(part: pa.RecordBatch, row: list) -> pa.RecordBatch:
            cols = [pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *names])

        for part in slices(batches, 1):
            try:
                for f in decode(part.column(1)[0].as_py() or b"", max_pixels):
                    h, w = f.canvas.shape[:2]
                    yield one(part, [f.index, f.start_ms, f.delay_ms, w, h, *histograms(f), f.canvas.tobytes(), None])
            except GifError as e:
                yield one(part, [None] * 9 + [str(e)])

    return df.select(id_col, media_col).mapInArrow(run, schema)


def read_back(media: bytes) -> tuple[bytes, int, int, list[list[int]]]:
    """Payload, frame count, playing time in ms and the summed colour histograms of a stored text."""
    parts, time, levels, n = [], 0, np.zeros((3, HISTOGRAM_BINS), dtype=np.int64), 0
    for f in decode(media):
        parts.append(f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0].tobytes())
        levels += histograms(f)
        time, n = f.start_ms + f.delay_ms, n + 1
    return b"".join(parts), n, time, levels.tolist()


def read(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Digests of stored texts, from the bytes of the media column as ``store`` writes it; rows are never merged.

    ``feature`` holds frames, playing time and the colour histograms of all frames.  Media that is null
    or broken raises GifError here; ``frames`` gives such rows an error instead.
    """
    schema = (
        f"doc_id {dict(df.dtypes)[id_col]}, n_bytes long, payload_bytes long, payload_sha256 string, "
        "tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for n, cell in zip(part.column(1).to_pylist(), part.column(2), strict=True):
                media = cell.as_py() or b""
                back, count, time, levels = read_back(media)
                colours = ";".join(f"{c}={','.join(map(str, x))}" for c, x in zip(("red", "green", "blue"), levels, strict=True))
                rows.append((
                    n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-WIDTH:]), len(media),
                    hashlib.sha256(media).hexdigest(), f"frames={count};ms={time};{colours}",
                ))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], names)

    return df.select(id_col, "n_bytes", media_col).mapInArrow(run, schema)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``store`` written to the shared folder as a media column, reread, and ``read`` from its bytes.

    Null and empty texts are one row of 64 zero bytes.  ``feature`` depends on the text alone.
    """
    folder = shared_folder(df.sparkSession, "gif")
    stored = store(df, id_col, text_col)
    stored.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(folder)
    return read(df.sparkSession.read.schema(stored.schema).parquet(folder))
