"""The image query request: its parameters, validation and dict form."""

from __future__ import annotations

import base64
import binascii
from dataclasses import dataclass, fields
from typing import Any

from lumisift.errors import QueryError
from lumisift.functions.hashing import hash_mode
from lumisift.operators.registry import feature_name

# The request keys of an image clause.
REQUEST_KEYS = ("feature", "image", "hash", "boost", "limit", "index", "type", "id", "path", "routing")


@dataclass(frozen=True, kw_only=True)
class ImageQuery:
    """One image clause.

    The query side is either ``image`` (encoded bytes) or a stored document named by
    ``index/type/id/path`` (and ``routing``); an image wins when both are given.
    """

    field: str
    feature: str
    image: bytes | None = None
    hash: str | None = None
    boost: float = 1.0
    limit: int = -1
    index: str | None = None
    type: str | None = None
    id: Any = None
    path: str | None = None
    routing: str | None = None

    def __post_init__(self) -> None:
        if not self.field:
            raise QueryError("an image clause needs the name of its field")
        if not self.feature:
            raise QueryError("an image clause needs a feature")
        object.__setattr__(self, "feature", feature_name(self.feature))
        if self.hash is not None:
            object.__setattr__(self, "hash", hash_mode(self.hash))
        if self.image is None and not self.has_lookup:
            raise QueryError("an image clause needs an image, or the type, id and path of a stored document")

    @property
    def has_lookup(self) -> bool:
        return self.type is not None and self.id is not None and self.path is not None

    @property
    def limited(self) -> bool:
        """A limit counts only together with a hash, and only when positive."""
        return self.hash is not None and self.limit > 0

    @classmethod
    def parse(cls, body: dict[str, dict[str, Any]]) -> ImageQuery:
        """From ``{field: {parameter: value}}``; unknown parameters are errors."""
        if not isinstance(body, dict) or len(body) != 1:
            raise QueryError("expected one field with the parameters of its image clause")
        ((field, params),) = body.items()
        for key in params:
            if key not in REQUEST_KEYS:
                raise QueryError(f"unknown parameter {key!r} of an image clause")
        if params.get("feature") is None:
            raise QueryError("an image clause needs a feature")
        given = {k: v for k, v in params.items() if v is not None}
        if isinstance(given.get("image"), str):  # bytes are base64 text in a request
            try:
                given["image"] = base64.b64decode(given["image"], validate=True)
            except binascii.Error as cause:
                raise QueryError("the image of an image clause is not base64") from cause
        return cls(field=field, **given)

    def to_dict(self) -> dict[str, dict[str, Any]]:
        """Dict form; parameters left at their default are omitted."""
        params = {}
        for f in fields(self):
            value = getattr(self, f.name)
            if f.name != "field" and value is not None and value != f.default:
                params[f.name] = base64.b64encode(value).decode() if f.name == "image" else value
        return {self.field: params}
