"""Pixels: lag differences, block differences, registration shift; Arrow-batched Python over grey planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Weights of blue, green and red in grey, as fractions of 2**14.
_BGR = (1868, 9617, 4899)


class PlaneError(ValueError):
    """A plane's bytes do not fit its width and height."""


def to_gray(frames: DataFrame, column: str = "bgr", name: str = "gray") -> DataFrame:
    """Frames with packed blue, green, red bytes as a grey plane ``name``, rounded as fixed-point weights give it.

    A null plane stays null; one whose length is not three times its area raises PlaneError.
    """
    rest = [c for c in frames.columns if c not in (column, name)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            planes = []
            for raw, w, h in zip(part[column], part["width"], part["height"], strict=True):
                if raw is None:
                    planes.append(None)
                    continue
                if len(raw) != 3 * w * h:
                    raise PlaneError(f"{len(raw)} bytes are no {w} x {h} colour plane")
                pixels = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
                planes.append(((pixels @ np.array(_BGR, dtype=np.int32) + (1 << 13)) >> 14).astype(np.uint8).tobytes())
            yield part[rest].assign(**{name: planes})

    kinds = dict(frames.dtypes)
    return frames.select(*rest, column).mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in rest) + f", `{name}` binary")


def _plane(raw: bytes | None, width: int, height: int) -> np.ndarray | None:
    if raw is None:
        return None
    if len(raw) != width * height:
        raise PlaneError(f"{len(raw)} bytes are no {width} x {height} plane")
    return np.frombuffer(raw, dtype=np.uint8).reshape(height, width).astype(np.int16)


def with_lag(frames: DataFrame, keys: list[str], lag: int = 1) -> DataFrame:
    """Frames with the plane ``lag`` frames before; none across a change of size."""
    w = Window.partitionBy(*keys).orderBy("frame_index")
    same = (F.lag("width", lag).over(w) == F.col("width")) & (F.lag("height", lag).over(w) == F.col("height"))
    return frames.withColumn("_before", F.when(same, F.lag("gray", lag).over(w)))


def frame_difference(frames: DataFrame, keys: list[str], threshold: int = 10, lag: int = 1) -> DataFrame:
    """Per frame: changed pixels (> threshold) and their summed difference, changed share, summed and mean
    absolute difference, mean signed change.  Frames without a predecessor of their size are 0, as are
    null planes; a plane of the wrong length raises PlaneError."""
    names = ["changed_pixels", "changed_sum", "changed_fraction", "abs_sum", "abs_mean", "signed_mean"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for now, before, w, h in zip(part["gray"], part["_before"], part["width"], part["height"], strict=True):
                a, b = _plane(now, w, h), _plane(before, w, h)
                if a is None or b is None:
                    rows.append((0, 0, 0.0, 0, 0.0, 0.0))
                    continue
                d = np.abs(a - b)
                over = d > threshold
                rows.append((int(over.sum()), int(d[over].sum()), float(over.mean()), int(d.sum()), float(d.mean()), float((a - b).mean())))
            yield pd.concat([part[[*keys, "frame_index"]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    kinds = dict(frames.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "frame_index"])
    return with_lag(frames, keys, lag).mapInPandas(
        run, schema + ", changed_pixels long, changed_sum long, changed_fraction double, abs_sum long, abs_mean double, signed_mean double"
    )


def lag_differences(frames: DataFrame, keys: list[str], lags: tuple[int, ...] = (1, 3, 10), threshold: int = 10) -> DataFrame:
    """Changed share and mean absolute difference at several lags, one column pair each."""
    by = [*keys, "frame_index"]
    out = frames.select(*by)
    for lag in lags:
        d = frame_difference(frames, keys, threshold, lag)
        out = out.join(d.select(*by, F.col("changed_fraction").alias(f"imgdiff_l{lag}_changed_fraction"), F.col("abs_mean").alias(f"imgdiff_l{lag}_abs_mean")), by)
    return out


def block_differences(vectors: DataFrame, frames: DataFrame, keys: list[str], threshold: int = 10, padding: int = 0) -> DataFrame:
    """Vectors with the mean and largest difference and the changed pixels of their block.

    The pixels of a vector's block are found by slicing its frame, so no pixel is joined to a vector.
    A first frame gives nulls for the differences and 0 changed pixels.  Columns of these names that the
    vectors have already are replaced.
    """
    by = [*keys, "frame_index"]
    vectors = vectors.drop("block_mean_diff", "block_max_diff", "block_cd_pixels")
    listed = vectors.withColumn("_v", F.struct(*vectors.columns)).groupBy(*by).agg(F.collect_list("_v").alias("_vs"))  # vectors of a frame
    planes = with_lag(frames, keys).select(*by, "gray", "_before", "width", "height")
    both = listed.join(planes, by)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            means, tops, counts = [], [], []
            for vs, now, before, w, h in zip(part["_vs"], part["gray"], part["_before"], part["width"], part["height"], strict=True):
                a, b = _plane(now, w, h), _plane(before, w, h)
                d = None if a is None or b is None else np.abs(a - b)
                m, t, c = [], [], []
                for v in vs:
                    x, y = int(v["dst_x"]), int(v["dst_y"])
                    rx, ry = max(int(v["w"]) // 2, 1) + padding, max(int(v["h"]) // 2, 1) + padding
                    block = None if d is None else d[max(0, y - ry) : min(h, y + ry), max(0, x - rx) : min(w, x + rx)]
                    empty = block is None or not block.size
                    m.append(None if empty else float(block.mean()))
                    t.append(None if empty else float(block.max()))
                    c.append(0 if empty else int((block > threshold).sum()))
                means.append(m)
                tops.append(t)
                counts.append(c)
            yield part[by].assign(_vs=part["_vs"], _m=means, _t=tops, _c=counts)

    kinds = dict(both.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in by) + f", _vs {kinds['_vs']}, _m array<double>, _t array<double>, _c array<int>"
    out = both.mapInPandas(run, schema).select(F.explode(F.arrays_zip("_vs", "_m", "_t", "_c")).alias("z"))
    return out.select("z._vs.*", F.col("z._m").alias("block_mean_diff"), F.col("z._t").alias("block_max_diff"), F.col("z._c").alias("block_cd_pixels"))


def phase_shift(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Per frame: whole-pixel shift to the frame before and the correlation peak; 0 without one."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for now, before, w, h in zip(part["gray"], part["_before"], part["width"], part["height"], strict=True):
                a, b = _plane(now, w, h), _plane(before, w, h)
                if a is None or b is None:
                    rows.append((0.0, 0.0, 0.0))
                    continue
                cross = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
                peak = np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)).real
                y, x = np.unravel_index(int(peak.argmax()), peak.shape)
                rows.append((float(x - w if x > w // 2 else x), float(y - h if y > h // 2 else y), float(peak.max())))
            yield pd.concat([part[[*keys, "frame_index"]].reset_index(drop=True), pd.DataFrame(rows, columns=["shift_x_px", "shift_y_px", "response"])], axis=1)

    kinds = dict(frames.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "frame_index"]) + ", shift_x_px double, shift_y_px double, response double"
    out = with_lag(frames, keys).mapInPandas(run, schema)
    return out.withColumn("shift_px", F.hypot("shift_x_px", "shift_y_px"))


def block_motion(frames: DataFrame, keys: list[str], block: int = 16, search: int = 7) -> DataFrame:
    """Exhaustive block matching against the frame before: one vector per block, least difference, shortest first."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shifts = sorted(((dy, dx) for dy in range(-search, search + 1) for dx in range(-search, search + 1)), key=lambda s: (s[0] ** 2 + s[1] ** 2, s))
        for part in parts:
            rows = []
            for *key, now, before, w, h in part[[*keys, "frame_index", "gray", "_before", "width", "height"]].itertuples(index=False):
                a, b = _plane(now, w, h), _plane(before, w, h)
                if a is None or b is None:
                    continue
                down, across = h // block, w // block
                if not down or not across:
                    continue
                here = a[: down * block, : across * block]
                best = np.full((down, across), np.iinfo(np.int64).max)
                which = np.zeros((down, across), dtype=np.int64)
                padded = np.pad(b, search)
                top, left = np.arange(down)[:, None] * block, np.arange(across)[None, :] * block
                for k, (dy, dx) in enumerate(shifts):
                    moved = padded[search + dy : search + dy + down * block, search + dx : search + dx + across * block]
                    cost = np.abs(here - moved).astype(np.int64).reshape(down, block, across, block).sum(axis=(1, 3))
                    inside = (top + dy >= 0) & (top + dy + block <= h) & (left + dx >= 0) & (left + dx + block <= w)
                    better = inside & (cost < best)
                    best[better], which[better] = cost[better], k
                for i, (r, c) in enumerate(np.ndindex(down, across)):
                    (dy, dx), y, x = shifts[which[r, c]], r * block, c * block
                    rows.append((*key, i, -1, block, block, x + dx + block // 2, y + dy + block // 2, x + block // 2, y + block // 2))
            yield pd.DataFrame(rows, columns=[*keys, "frame_index", "vector_index", "source", "w", "h", "src_x", "src_y", "dst_x", "dst_y"])

    kinds = dict(frames.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "frame_index"]) + ", vector_index int, source int, w int, h int, src_x int, src_y int, dst_x int, dst_y int"
    return with_lag(frames, keys).mapInPandas(run, schema)
