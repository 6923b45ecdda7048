"""Intermediate tables that outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumisift.session import shared_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """A table written once to the shared folder and read back: what follows no longer depends on the executors that
    made it, and uses of it do not compute it again."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
