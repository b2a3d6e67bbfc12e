"""Manifests: regions joined to sources, plate and well rows, paging, partitions, validation, staging plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrace.functions.exprs import basename, blank_to_null, parent, ratio, sentinels, stem

MERGED = ("source_path", "source_fingerprint", "video_width", "video_height", "pixel_format", "fps_nominal", "frame_count", "duration_s")


class ManifestError(ValueError):
    """The catalogue or region table breaks a rule of the manifest."""


def normalise_roi(roi: DataFrame) -> DataFrame:
    """``analysis_roi_*`` columns, where the table has them, under their plain names."""
    renamed = {c: c.removeprefix("analysis_") for c in roi.columns if c.startswith("analysis_roi_")}
    keep = [c for c in roi.columns if c not in renamed.values() or c in renamed]
    return roi.select(*[F.col(c).alias(renamed.get(c, c)) for c in keep])


def check_catalog(catalog: DataFrame, roi: DataFrame) -> None:
    """Raise where the catalogue repeats an id or lacks one that a region refers to."""
    twice = catalog.groupBy("source_video_id").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ManifestError(f"duplicate source_video_id in the catalogue: {twice[0][0]}")
    absent = roi.join(catalog, "source_video_id", "left_anti").limit(1).collect()
    if absent:
        raise ManifestError(f"source_video_id absent from the catalogue: {absent[0]['source_video_id']}")


def _whole(x: Column) -> Column:
    """Text as a whole number by way of a double; blanks are missing."""
    return blank_to_null(x).try_cast("double").cast("int")


def geometry(roi: DataFrame) -> DataFrame:
    """crop_width and crop_height: the stated size, else the difference of the corners."""
    size = lambda stated, low, high: F.coalesce(
        _whole(F.col(stated)) if stated in roi.columns else F.lit(None).cast("int"),
        (blank_to_null(high).try_cast("double") - blank_to_null(low).try_cast("double")).cast("int"),
    )
    return roi.withColumns({"crop_width": size("roi_width", "roi_x0", "roi_x1"), "crop_height": size("roi_height", "roi_y0", "roi_y1")})


def wells(catalog: DataFrame, roi: DataFrame, output_root: str = "runs", skip_missing: bool = False, order: str = "row_pos") -> DataFrame:
    """Well rows: catalogue values where not blank, else the region's; plates numbered by first appearance.

    With ``skip_missing`` rows without a source path are left out before plates are numbered.
    """
    shared = [c for c in MERGED if c in catalog.columns or c in roi.columns]
    left = roi.select(*[F.col(c).alias(f"_roi_{c}") if c in shared else F.col(c) for c in roi.columns])
    right = catalog.select("source_video_id", *[F.col(c).alias(f"_src_{c}") for c in shared if c in catalog.columns])
    both = left.join(right, "source_video_id")
    pick = lambda c: F.coalesce(*[blank_to_null(x) for x in (f"_src_{c}", f"_roi_{c}") if x in both.columns], F.lit(""))
    out = both.withColumns({c: pick(c) for c in shared}).drop(*[c for c in both.columns if c.startswith(("_roi_", "_src_"))])
    if skip_missing:
        out = out.filter(F.col("source_path") != "")
    first = out.groupBy("source_video_id").agg(F.min(order).alias("_first"))
    # One row per source; numbering all of them in order takes a single sort of that small table.
    number = F.row_number().over(Window.orderBy("_first"))
    out = out.join(first.select("source_video_id", number.cast("long").alias("plate_task_id")), "source_video_id")
    folder = F.concat(F.lit(f"{output_root}/"), F.col("source_video_id"))
    return geometry(out).withColumns({
        "output_dir": folder,
        "well_archive_path": F.concat(folder, F.lit("/video/"), F.col("source_video_id"), F.lit("_"), F.col("well_label"), F.lit(".av1.mkv")),
        "well_sidecar_dir": F.concat(folder, F.lit("/sidecar/mv_v1/"), F.col("well_label")),
    })


def missing_sources(catalog: DataFrame, roi: DataFrame) -> DataFrame:
    """One row: region rows whose source path is blank in both tables."""
    return wells(catalog, roi).agg(F.count(F.when(F.col("source_path") == "", 1)).alias("skipped_missing_source_path"))


def plates(well_rows: DataFrame) -> DataFrame:
    """One row per plate with its number of wells, in task order."""
    return well_rows.groupBy("plate_task_id", "source_video_id").agg(
        F.max("source_path").alias("source_path"), F.max("output_dir").alias("output_dir"), F.count("*").alias("n_wells")
    )


def page(rows: DataFrame, size: int, task: int, order: str = "plate_task_id") -> DataFrame:
    """Rows [(task - 1) * size, task * size) of a table numbered 1.. in ``order``; past the end is an error."""
    if size < 1 or task < 1:
        raise ValueError("size and task count from 1")
    total = rows.count()
    if (task - 1) * size >= total:
        raise IndexError(f"task {task} is past the last of {-(-total // size)} chunks")
    return rows.filter((F.col(order) > (task - 1) * size) & (F.col(order) <= task * size))


def balanced(rows: DataFrame, groups: int, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of each key in ``groups`` contiguous groups, 1.., the first ones larger; never more groups than rows."""
    if groups < 1:
        raise ValueError("groups count from 1")
    return rows.withColumn("group", F.ntile(groups).over(Window.partitionBy(*keys).orderBy(*order)))


def crop_filter(well_rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key, the text of a filter graph that splits a grey stream and crops every well in order."""
    item = F.struct(F.col(order).alias("o"), "crop_width", "crop_height", _whole(F.col("roi_x0")).alias("x"), _whole(F.col("roi_y0")).alias("y"))
    rows = well_rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("w"))  # at most the wells of a plate
    n = F.size("w")
    split = F.concat(
        F.lit("[0:v]format=gray,split="), n.cast("string"),
        F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("[s"), i.cast("string"), F.lit("]"))), ""),
    )
    crop = F.transform("w", lambda r, i: F.format_string("[s%d]crop=%d:%d:%d:%d[v%d]", i, r["crop_width"], r["crop_height"], r["x"], r["y"], i))
    return rows.select(*keys, F.concat_ws(";", split, F.array_join(crop, ";")).alias("crop_filter"))


def sentinel_rows(well_rows: DataFrame, count: int, keys: list[str], order: str) -> DataFrame:
    """Rows with their position in the key and whether it is one of ``count`` evenly spaced sentinels."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    total = F.count("*").over(Window.partitionBy(*keys))
    out = well_rows.withColumns({"position": place, "_total": total})
    return out.withColumn("is_sentinel", F.array_contains(sentinels("_total", count), F.col("position"))).drop("_total")


def violations(well_rows: DataFrame, probe: DataFrame, key: str, plate: str, codec: str = "av1") -> DataFrame:
    """(plate, key, rule) for every broken output rule: missing, codec, geometry, empty, counts differ."""
    whole = Window.partitionBy(plate)
    both = well_rows.join(probe, key, "left").withColumns({"_most": F.max("packet_count").over(whole), "_least": F.min("packet_count").over(whole)})
    rules = F.array(
        F.when(F.col("codec_name").isNull(), "missing"), F.when(F.col("codec_name") != codec, "codec"),
        F.when((F.col("width") != F.col("crop_width")) | (F.col("height") != F.col("crop_height")), "geometry"),
        F.when(F.col("packet_count") <= 0, "empty"), F.when(F.col("_most") != F.col("_least"), "counts_differ"),
    )
    return both.withColumn("rule", F.explode(F.filter(rules, lambda r: r.isNotNull()))).select(plate, key, "rule")


def task_status(
    facts: DataFrame, slots: int, threads: int = 1, processes: int = 1, max_seconds: float = 0.0, force: bool = False, dry_run: bool = False
) -> DataFrame:
    """What a plate task would end as, from facts: source_exists, duration_s, n_wells, n_existing, encoder_ok, valid, copied."""
    status = F.when(F.lit(threads * processes > slots), "encoder_cpu_request_exceeds_sge_slots").when(~F.col("source_exists"), "missing_source")
    if max_seconds > 0:
        status = status.when(F.col("duration_s") > max_seconds, "source_duration_exceeds_limit")
    if not force:
        status = status.when(F.col("n_existing") == F.col("n_wells"), "skipped_existing").when(F.col("n_existing") > 0, "partial_existing_outputs")
    if dry_run:
        return facts.withColumn("status", status.otherwise("dry_run"))
    status = status.when(~F.col("encoder_ok"), "ffmpeg_failed").when(~F.col("copied"), "output_rsync_failed").when(F.col("valid"), "validated")
    return facts.withColumn("status", status.otherwise("encoding"))


def stage_plan(plate_rows: DataFrame, staged: DataFrame, cap: int) -> DataFrame:
    """The next plates to stage in task order: those not staged, up to ``cap`` less what is; no cap if 0."""
    left = plate_rows.join(staged.select("source_video_id"), "source_video_id", "left_anti")
    if not cap:
        return left
    done = plate_rows.join(staged.select("source_video_id"), "source_video_id", "left_semi").count()
    return left.orderBy("plate_task_id").limit(max(0, cap - done))


def collect_plan(plate_rows: DataFrame, validation: DataFrame) -> DataFrame:
    """Plates whose validation ended as validated."""
    return plate_rows.join(validation.filter(F.col("status") == "validated"), "source_video_id", "left_semi")


def retire_plan(plate_rows: DataFrame, validation: DataFrame, staged: DataFrame) -> DataFrame:
    """Validated plates whose input is still staged."""
    return collect_plan(plate_rows, validation).join(staged, "source_video_id", "left_semi")


def tasks(inputs: DataFrame, output_root: str, input_root: str | None = None, **defaults) -> DataFrame:
    """Task rows numbered from 1 in input order, with output folders that may keep the input's layout."""
    number = F.row_number().over(Window.orderBy("input_path")).cast("long")  # a list of files
    inner = F.lit("")
    if input_root:
        root = input_root.rstrip("/") + "/"
        folder = F.concat(parent("input_path"), F.lit("/"))
        inner = F.when(folder.startswith(root), F.substr(folder, F.lit(len(root) + 1))).otherwise(F.lit(""))
    folder = F.concat(F.lit(output_root.rstrip("/") + "/"), inner, stem("input_path"))
    return inputs.select(number.alias("task_id"), "input_path", folder.alias("output_dir"), *[F.lit(v).alias(k) for k, v in defaults.items()])


def task_row(rows: DataFrame, index: int, **defaults) -> DataFrame:
    """The one-based task row, blanks replaced by the given defaults."""
    row = rows.filter(F.col("task_id") == index)
    return row.withColumns({k: F.coalesce(blank_to_null(k), F.lit(str(v))) for k, v in defaults.items() if k in rows.columns})


def routed(rows: DataFrame, root: str, column: str = "well_archive_path") -> DataFrame:
    """The column's files under another root, by plate."""
    return rows.withColumn(column, F.concat(F.lit(root.rstrip("/") + "/"), F.col("source_video_id"), F.lit("/video/"), basename(column)))


def batch_summary(items: DataFrame) -> DataFrame:
    """Integrated sidecars by status: count, bytes in and out, and their ratio."""
    out = items.groupBy("status").agg(F.count("*").alias("n"), F.sum("input_bytes").alias("input_bytes"), F.sum("output_bytes").alias("output_bytes"))
    return out.withColumn("output_to_input_ratio", ratio("output_bytes", "input_bytes"))


def incomplete(work: DataFrame, present: DataFrame, key: list[str]) -> DataFrame:
    """Work items without an existing output."""
    return work.join(present, key, "left_anti")


def arm_medians(runs: DataFrame, baseline: str) -> DataFrame:
    """Median seconds of every benchmark arm and their ratio to the baseline arm."""
    med = runs.groupBy("arm").agg(F.percentile("seconds", F.lit(0.5)).alias("median_s"))
    base = med.filter(F.col("arm") == baseline).select(F.col("median_s").alias("_base"))
    return med.crossJoin(F.broadcast(base)).withColumn("relative", ratio("median_s", "_base")).drop("_base")  # one row


def capacity(plates_: int, concurrency: int, hours: float, source_gb: float, crop_gb: float, inter_gb: float, output_gb: float) -> dict[str, float]:
    """Shared scratch peak in GB and wall hours of a campaign."""
    return {
        "shared_peak_gb": concurrency * (source_gb + crop_gb + inter_gb + output_gb),
        "wall_hours": plates_ * hours / concurrency,
    }


def plate_template(spark, rows: int = 8, cols: int = 12, pitch: float = 83.0, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Wells of a plate grid: label, row-major index and corners."""
    grid = spark.range(rows * cols).select(F.col("id").alias("well_index"), F.floor(F.col("id") / cols).cast("int").alias("r"), (F.col("id") % cols).cast("int").alias("c"))
    label = F.concat(F.chr(F.col("r") + 65), F.lpad((F.col("c") + 1).cast("string"), 2, "0"))
    x0, y0 = F.col("c") * pitch + origin[0], F.col("r") * pitch + origin[1]
    return grid.select(label.alias("well_label"), "well_index", x0.alias("roi_x0"), y0.alias("roi_y0"), (x0 + pitch).alias("roi_x1"), (y0 + pitch).alias("roi_y1"))


#: Well centres of the 24-well plate in pixels of a 1664 x 1440 frame, by column and by row.
CENTRES_24 = ((138, 400, 662, 925, 1187, 1450), (137, 400, 663, 927))
#: First corner, pitch and size of the 96 wells in pixels of a 1600 x 1068 frame.
GRID_96 = {"origin": (22, 16), "pitch": (131, 132), "size": (112, 109)}
#: The layout that a frame size stands for.
LAYOUT_OF_SIZE = {(1600, 1068): "s24_96", (1664, 1440): "s22_24"}


def layout_of(width: int, height: int, layout: str = "auto") -> str:
    """The named layout, or under "auto" the one of the frame size; ManifestError where there is none."""
    name = LAYOUT_OF_SIZE.get((width, height)) if layout == "auto" else layout
    if name not in LAYOUT_OF_SIZE.values():
        raise ManifestError(f"no plate layout for {layout} at {width} x {height}")
    return name


def plate_layout(spark, layout: str, crop: int = 256) -> DataFrame:
    """Wells of a layout: label, row-major index and whole-pixel corners; ``crop`` is the side of a well around its centre."""
    name = layout_of(0, 0, layout)
    columns, rows = (6, 4) if name == "s22_24" else (12, 8)
    grid = spark.range(rows * columns).select(
        F.col("id").alias("well_index"), F.floor(F.col("id") / columns).cast("int").alias("r"), (F.col("id") % columns).cast("int").alias("c")
    )
    label = F.concat(F.chr(F.col("r") + 65), F.lpad((F.col("c") + 1).cast("string"), 2, "0"))
    if name == "s22_24":
        half = crop // 2
        at = [F.get(F.array(*map(F.lit, centres)), F.col(i)) for centres, i in zip(CENTRES_24, "cr", strict=True)]
        low, high = [x - half for x in at], [x + half for x in at]
    else:
        low = [F.col(i) * step + first for i, step, first in zip("cr", GRID_96["pitch"], GRID_96["origin"], strict=True)]
        high = [x + size for x, size in zip(low, GRID_96["size"], strict=True)]
    corners = {"roi_x0": low[0], "roi_y0": low[1], "roi_x1": high[0], "roi_y1": high[1]}
    return grid.select(label.alias("well_label"), "well_index", *[x.cast("int").alias(c) for c, x in corners.items()])
