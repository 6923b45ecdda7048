"""Content-based image retrieval expressed as Spark DataFrame jobs."""

from lumisift.errors import ImageProcessError, MappingError, QueryError

__all__ = ["ImageProcessError", "MappingError", "QueryError"]
