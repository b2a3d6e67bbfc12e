"""Table schemas: the fixed column names and types of vector, frame, manifest and annotation tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "short": T.ShortType(), "double": T.DoubleType(), "string": T.StringType()}


def _struct(text: str) -> T.StructType:
    """A schema from "name type" pairs."""
    pairs = [x.split() for x in text.strip().split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: Fixed format: vector rows, 18 columns in file order.
VECTORS = _struct(
    "frame_index long, pts long, time_seconds double, vector_index int, source int, w long, h long, src_x short, "
    "src_y short, dst_x short, dst_y short, motion_x int, motion_y int, motion_scale long, flags long, dx_px int, "
    "dy_px int, magnitude_px double"
)
#: Fixed format: frame summary rows, 19 columns in file order.
FRAMES = _struct(
    "frame_index long, pts long, time_seconds double, n_vectors int, mean_dx_px double, mean_dy_px double, "
    "mean_magnitude_px double, median_magnitude_px double, p90_magnitude_px double, p95_magnitude_px double, "
    "max_magnitude_px double, sum_magnitude_px double, resultant_magnitude_px double, coherence double, "
    "frame_diff_threshold int, frame_diff_changed_pixels long, frame_diff_changed_fraction double, "
    "frame_diff_abs_sum long, frame_diff_abs_mean double"
)
#: Fixed format: struct codes, header magic and record size of the binary streams (32-byte headers).
BINARY = {
    "vectors": (b"MSCVB1\0\0", "<qqfiiIIhhhhiiIQiif", VECTORS),
    "frames": (b"MSCFB1\0\0", "<qqfi10fiqfqf", FRAMES),
}
#: Fixed format: columns of the source catalogue.
SOURCE_CATALOG = (
    "source_video_id", "source_path", "source_fingerprint", "video_width", "video_height", "pixel_format",
    "fps_nominal", "frame_count", "duration_s",
)
#: Fixed format: columns of the plain region table.
ROI_SIMPLE = (
    "source_video_id", "well_label", "well_index", "roi_x0", "roi_y0", "roi_x1", "roi_y1", "roi_width", "roi_height",
)
METADATA = T.StructType([
    *_struct("schema_name string, schema_version string"),
    T.StructField("input", _struct("path string, sha256 string, width int, height int, nominal_fps string, time_base string")),
    T.StructField("frame_summary_encoding", _struct("format string, float_precision int")),
    T.StructField("vector_sampling", _struct("mode string, source string, frame_stride int, spatial_stride int, min_magnitude double")),
    T.StructField("outputs", T.MapType(T.StringType(), T.StringType())),
])


def record_types(kind: str) -> list[str]:
    """Little-endian array types of a binary record's fields, from its struct code."""
    kinds = {"q": "<i8", "i": "<i4", "I": "<u4", "h": "<i2", "f": "<f4", "d": "<f8", "Q": "<u8"}
    return [kinds[c] for count, c in re.findall(r"(\d*)([a-zA-Z])", BINARY[kind][1]) for _ in range(int(count or 1))]


class SchemaError(ValueError):
    """A table lacks required columns."""


def require(columns: list[str] | tuple[str, ...], present: list[str], table: str = "table") -> None:
    """Raise SchemaError naming the columns that ``present`` lacks."""
    missing = [c for c in columns if c not in present]
    if missing:
        raise SchemaError(f"{table} lacks columns: {', '.join(missing)}")
