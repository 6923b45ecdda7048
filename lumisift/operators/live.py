"""Document visibility: latest version, tombstones and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def as_of(versions: DataFrame, snapshot: int, version: str = "version") -> DataFrame:
    """What a reader sees after the refresh numbered ``snapshot``."""
    return versions.filter(F.col(version) <= F.lit(snapshot))


def latest(versions: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """Newest version of each document.

    ``max`` over a struct combines on the map side, so a document rewritten millions of times is
    reduced before the shuffle; a window over the key would put all its versions in one task.
    """
    rest = [c for c in versions.columns if c not in keys and c != version]
    newest = F.max_by(F.struct(version, *rest), F.col(version)).alias("newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def without_deleted(docs: DataFrame, tombstones: DataFrame, keys: Sequence[str]) -> DataFrame:
    return docs.join(tombstones.select(*keys), list(keys), "left_anti")


def live(versions: DataFrame, tombstones: DataFrame | None, keys: Sequence[str], version: str = "version") -> DataFrame:
    newest = latest(versions, keys, version)
    return newest if tombstones is None else without_deleted(newest, tombstones, keys)
