"""Exceptions raised while a plan is being built (data errors become columns instead)."""


class ImageProcessError(Exception):
    """A stored or submitted image could not be processed; wraps the cause."""


class MappingError(ValueError):
    """A field mapping is malformed."""


class QueryError(ValueError):
    """An image query is malformed or incomplete."""
