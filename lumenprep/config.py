"""Settings of the curation engine: nested mappings (YAML or dict) become frozen dataclasses; unknown keys are ignored."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any


@dataclass(frozen=True)
class FilterConfig:
    min_resolution: int = 256
    max_resolution: int | None = None
    nsfw_threshold: float = 0.5
    phash_threshold: int = 8
    nsfw_batch_size: int = 16
    watermark_ratio: float = 0.3
    order: tuple[str, ...] = ("resolution", "nsfw", "dedup")


@dataclass(frozen=True)
class BinningConfig:
    text_boxes_threshold: int = 2
    text_area_threshold: float = 0.2
    object_count_threshold: int = 5
    unique_objects_threshold: int = 3
    clip_similarity_threshold: float = 0.25
    spatial_dispersion_threshold: float = 0.3
    ratios: tuple[float, float, float] = (0.4, 0.4, 0.2)
    object_detector: str = "yolo"
    captioner: str = "blip"
    ocr: str = "paddle"


@dataclass(frozen=True)
class ValidationConfig:
    min_question_length: int = 5
    max_question_length: int = 200
    min_answer_length: int = 1
    max_answer_length: int = 500
    min_reasoning_length: int = 10
    grounding_overlap: float = 0.3


@dataclass(frozen=True)
class Config:
    filtering: FilterConfig = field(default_factory=FilterConfig)
    binning: BinningConfig = field(default_factory=BinningConfig)
    validation: ValidationConfig = field(default_factory=ValidationConfig)


def from_mapping(kind: type, values: dict[str, Any] | None) -> Any:
    """An instance of a settings class from a nested mapping; keys that the class doesn't have are left out."""
    values, got = values or {}, {}
    for f in fields(kind):
        if f.name in values:
            default = f.default_factory() if callable(f.default_factory) else f.default  # type: ignore[misc]
            x = values[f.name]
            got[f.name] = from_mapping(type(default), x) if is_dataclass(default) else tuple(x) if isinstance(default, tuple) else x
    return kind(**got)


def load(path: str) -> Config:
    """Reads a YAML file of settings."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML settings needs the yaml library; pass a mapping to from_mapping() instead") from e
    with open(path) as f:
        return from_mapping(Config, yaml.safe_load(f))


def normalised_ratios(ratios: tuple[float, ...]) -> tuple[float, ...]:
    """Scaled to a sum of 1 if the sum is off by more than 0.01."""
    total = sum(ratios)
    return tuple(r / total for r in ratios) if abs(total - 1) > 0.01 and total else tuple(ratios)
