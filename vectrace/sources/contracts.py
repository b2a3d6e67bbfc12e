"""Quality-control contracts: a JSON document that says which features are made, and the plans it asks for."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from vectrace.operators import features, imgdiff, qc


class ContractError(ValueError):
    """A contract lacks a part or asks for what cannot be made."""


@dataclass(frozen=True)
class Contract:
    """The parts of a contract that plans are built from."""

    name: str
    lags: tuple[int, ...]
    thresholds: tuple[int, ...]
    grid: tuple[int, int]
    bins_ms: tuple[int, ...]
    well: tuple[str, ...]
    plate: tuple[str, ...]
    summaries: tuple[str, ...]
    derived: tuple[str, ...]
    rejects: bool
    versioned: tuple[str, ...]

    def image_features(self, frames: DataFrame, keys: list[str], threshold: int | None = None) -> DataFrame:
        """Pixel change at every lag of the contract; with several thresholds one must be chosen."""
        if threshold is None:
            if len(self.thresholds) != 1:
                raise ContractError("the contract has several thresholds; choose one")
            threshold = self.thresholds[0]
        return imgdiff.lag_differences(frames, keys, self.lags, threshold)

    def bins(self, table: DataFrame, keys: list[str]) -> DataFrame:
        """Temporal bins of all widths of the contract over frame features."""
        return features.temporal_bins(table, keys, self.bins_ms)

    def windows(self, rows: DataFrame, value: str, active: Column, keys: list[str], seconds: float = 1.0) -> DataFrame:
        """The window summaries that the contract names, of one value."""
        found = qc.window_summary(rows, value, active, keys, seconds)
        return found.select(*keys, "window_index", *self.summaries)

    def missing(self, table: DataFrame, part: str = "well") -> list[str]:
        """Columns that the contract's part ("well", "plate" or "derived") names and the table lacks."""
        return [c for c in getattr(self, part) if c not in table.columns]


def parse(text: str) -> Contract:
    """A contract from its JSON; a part that is absent or of another type raises ContractError.

    Parameters that a document leaves to a version ("..._required") are listed in ``versioned``: whoever
    builds a plan must give them.
    """
    try:
        doc = json.loads(text)
        found = Contract(
            doc["feature_set"], tuple(map(int, doc["image_dynamics"]["lags_frames"])), tuple(map(int, doc["image_dynamics"]["changed_pixel_thresholds"])),
            tuple(map(int, doc["motion_vectors"]["preaggregate_spatial_grid"])), tuple(map(int, doc["temporal"]["bins_ms"])),
            tuple(doc["transcode_trace_features"]["well"]), tuple(doc["transcode_trace_features"]["plate_context"]),
            tuple(doc["derived_after_transcode"]["window_summaries"]), tuple(doc["derived_after_transcode"]["features"]),
            bool(doc["decision_semantics"]["automatic_rejection"]), tuple(sorted(_versioned(doc))),
        )
    except (KeyError, TypeError, ValueError) as e:
        raise ContractError(f"not a contract: {e}") from e
    unknown = set(found.summaries) - {"median", "p95", "max", "auc", "active_frame_fraction"}
    if unknown or len(found.grid) != 2 or min(*found.lags, *found.grid, *found.bins_ms) < 1:
        raise ContractError(f"the contract asks for what cannot be made: {sorted(unknown) or [found.lags, found.grid, found.bins_ms]}")
    return found


def _versioned(doc: object, at: str = "") -> list[str]:
    if isinstance(doc, dict):
        return [x for k, v in doc.items() for x in _versioned(v, f"{at}.{k}" if at else k)]
    return [at] if isinstance(doc, str) and doc.endswith("_required") else []


def read_contract(spark: SparkSession, path: str) -> Contract:
    """The contract in one JSON file, on any store that Spark reads."""
    return parse(spark.read.text(path, wholetext=True).first()[0])
