"""Feature names, vector lengths and metrics."""

from __future__ import annotations

from dataclasses import dataclass

from lumisift.errors import QueryError


@dataclass(frozen=True)
class Feature:
    name: str
    dim: int
    metric: str


_FEATURES: dict[str, Feature] = {}


def register_feature(name: str, dim: int, metric: str) -> Feature:
    """Make a feature known by name; user descriptors register the same way as built-in ones."""
    feature = Feature(name.upper(), dim, metric)
    _FEATURES[feature.name] = feature
    return feature


# The supported feature names. Lengths and metrics are this library's own definitions.
for _name, _dim, _metric in (
    ("AUTO_COLOR_CORRELOGRAM", 192, "l1"),
    ("BINARY_PATTERNS_PYRAMID", 756, "l1"),
    ("CEDD", 144, "tanimoto"),
    ("SIMPLE_COLOR_HISTOGRAM", 64, "jsd"),
    ("COLOR_LAYOUT", 12, "layout"),
    ("EDGE_HISTOGRAM", 80, "l1"),
    ("FCTH", 192, "tanimoto"),
    ("GABOR", 16, "l2"),
    ("JCD", 168, "tanimoto"),
    ("JOINT_HISTOGRAM", 576, "jsd"),
    ("JPEG_COEFFICIENT_HISTOGRAM", 256, "l1"),
    ("LOCAL_BINARY_PATTERNS", 256, "l1"),
    ("LUMINANCE_LAYOUT", 64, "l1"),
    ("OPPONENT_HISTOGRAM", 64, "jsd"),
    ("PHOG", 168, "l1"),
    ("ROTATION_INVARIANT_LOCAL_BINARY_PATTERNS", 36, "l1"),
    ("SCALABLE_COLOR", 64, "l1"),
    ("TAMURA", 18, "l2"),
    # Ready-made vectors take the place of an extracted feature.
    ("EMBEDDING", 64, "cosine"),
):
    register_feature(_name, _dim, _metric)


def feature_name(name: str) -> str:
    """Upper-case lookup of a feature name."""
    if not isinstance(name, str) or name.upper() not in _FEATURES:
        raise QueryError(f"unknown feature {name!r}; known: {', '.join(sorted(_FEATURES))}")
    return name.upper()


def feature(name: str) -> Feature:
    return _FEATURES[feature_name(name)]


def features() -> tuple[str, ...]:
    return tuple(sorted(_FEATURES))


def metric_of(name: str) -> str:
    return feature(name).metric
