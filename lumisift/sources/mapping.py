"""Declared mapping of an image field, validated before any job runs."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T

from lumisift.errors import MappingError, QueryError
from lumisift.functions.hashing import hash_mode
from lumisift.operators.registry import feature_name

# Declared scalar types of metadata sub-fields and their Spark types.
SCALAR_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.IntegerType(), "long": T.LongType(), "short": T.ShortType(),
    "byte": T.ByteType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(),
    "date": T.TimestampType(), "binary": T.BinaryType(),
}


@dataclass(frozen=True)
class ImageMapping:
    """``features`` maps each feature to its hash modes, ``metadata`` each key to its declaration."""

    name: str
    features: dict[str, tuple[str, ...]]
    metadata: dict[str, dict[str, Any]] = field(default_factory=dict)

    @classmethod
    def parse(cls, name: str, node: MappingType[str, Any]) -> ImageMapping:
        if node.get("type", "image") != "image":
            raise MappingError(f"{name} is not an image field")
        declared = node.get("feature")
        if not declared:
            raise MappingError("a mapping needs at least one feature")
        features = {}
        for key, options in declared.items():
            try:
                features[feature_name(key)] = _hashes(options or {})
            except QueryError as exc:
                raise MappingError(str(exc)) from exc
        metadata = {}
        for key, options in (node.get("metadata") or {}).items():
            if options.get("type") not in SCALAR_TYPES:
                raise MappingError(f"unknown type of a metadata key [{options.get('type')}] declared on field [{key}]")
            metadata[key] = dict(options)
        return cls(name, features, metadata)

    def to_dict(self) -> dict[str, Any]:
        """The declaration back, with hash modes as lists."""
        return {
            self.name: {
                "type": "image",
                "feature": {f: ({"hash": list(h)} if h else {}) for f, h in self.features.items()},
                "metadata": {k: dict(v) for k, v in self.metadata.items()},
            }
        }

    def sub_fields(self, spark: SparkSession) -> DataFrame:
        """``(field, sub_field, kind, type, stored, indexed)`` of everything the field expands to."""
        rows = []
        for feature, modes in self.features.items():
            rows.append((self.name, f"{self.name}.{feature}", "feature", "binary", True, False))
            rows += [(self.name, f"{self.name}.{feature}.hash.{m}", "hash", "string", True, True) for m in modes]
        for key, options in self.metadata.items():
            stored = options.get("store") in (True, "yes", "true")
            rows.append((self.name, f"{self.name}.metadata.{key}", "metadata", options["type"], stored, options.get("index") != "no"))
        return spark.createDataFrame(
            rows, "field string, sub_field string, kind string, type string, stored boolean, indexed boolean"
        )

    def schema(self) -> T.StructType:
        """Columns of a stored document, one vector per feature and one signature per hash mode."""
        numbers = T.ArrayType(T.LongType())
        fields = [T.StructField("doc_id", T.LongType(), False)]
        for feature, modes in self.features.items():
            fields.append(T.StructField(feature, numbers))
            fields += [T.StructField(f"{feature}.hash.{m}", numbers) for m in modes]
        fields += [
            T.StructField(f"metadata.{k}", T.ArrayType(SCALAR_TYPES[v["type"]])) for k, v in self.metadata.items()
        ]
        return T.StructType(fields)


def _hashes(options: MappingType[str, Any]) -> tuple[str, ...]:
    declared = options.get("hash")
    if declared is None:
        return ()
    if isinstance(declared, str):
        return (hash_mode(declared),)
    if isinstance(declared, (list, tuple)):
        return tuple(hash_mode(h) for h in declared)
    raise MappingError("hashes are a name or a list of names")


def parse_properties(document_mapping: MappingType[str, Any]) -> tuple[dict[str, ImageMapping], list[str]]:
    """Image fields of a whole document mapping and the columns excluded from the stored source."""
    properties = document_mapping.get("properties", {})
    images = {k: ImageMapping.parse(k, v) for k, v in properties.items() if v.get("type") == "image"}
    return images, list((document_mapping.get("_source") or {}).get("excludes", []))
