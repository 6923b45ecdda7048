"""A log of commits: which files of a store belong to it, in an order that holds across streams.

A store is a folder with a folder for each of its tables and one for the log. A batch writes its tables into folders that
carry the name of the attempt, then a manifest names the attempt. Manifests are numbered, and a number can be taken once
only, so commits of all streams are in one order. Readers list the log and read the attempts it names: what an attempt
wrote before it failed, or writes at this moment, is not there for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

LOG = "_commits"
MANIFEST = "number bigint, attempt string, stream string, batch bigint, covers bigint"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def manifests(spark: SparkSession, store: str) -> list:
    """Committed manifests by number; a file that is not whole yet is none."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{store}/{LOG}").filter("attempt IS NOT NULL").collect()
    except AnalysisException:  # nothing was committed yet
        return []
    return sorted(rows, key=lambda r: r.number)


def live(spark: SparkSession, store: str) -> list:
    """The manifests readers look at: the last compaction and what it does not cover."""
    rows = manifests(spark, store)
    compacted = [r for r in rows if r.covers is not None]
    if not compacted:
        return rows
    last = max(compacted, key=lambda r: r.covers)
    return [last] + [r for r in rows if r.covers is None and r.number > last.covers]


def _publish(spark: SparkSession, store: str, **entry: object) -> int:
    """Writes a manifest under the next free number; creating its file fails where another stream was faster."""
    fs, folder = _file_system(spark, f"{store}/{LOG}")
    fs.mkdirs(folder)
    number = max((int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(folder) if f.getPath().getName()[0].isdigit()), default=0) + 1
    while True:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:020d}.json")
        try:
            out = fs.create(path, False)
            break
        except Py4JJavaError:
            if not fs.exists(path):
                raise
            number += 1
    out.write(bytearray(json.dumps({"number": number, **entry}), "utf-8"))
    out.close()
    return number


def commit(
    spark: SparkSession, store: str, tables: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]],
    stream: str | None = None, batch: int | None = None, covers: int | None = None,
) -> bool:
    """Writes the tables of an attempt, one after the other, and commits it; ``False`` if that batch of the stream is
    committed already. A table is made by a function, which may read those before it by their names."""
    if stream is not None and any((r.stream, r.batch) == (stream, batch) for r in manifests(spark, store)):
        return False
    attempt = uuid.uuid4().hex
    written = lambda name: spark.read.parquet(f"{store}/{name}/attempt={attempt}")
    for name, make in tables.items():
        make(written).write.parquet(f"{store}/{name}/attempt={attempt}")
    _publish(spark, store, attempt=attempt, stream=stream, batch=batch, covers=covers)
    return True


def committed(spark: SparkSession, store: str, name: str) -> DataFrame:
    """All committed rows of a table, with the number of their ``commit``. Only folders of committed attempts are listed."""
    rows = live(spark, store)
    if not rows:
        raise AnalysisException(f"nothing is committed in {store}")
    order = spark.createDataFrame([(r.attempt, r.covers if r.covers is not None else r.number) for r in rows], "attempt string, commit bigint")
    read = spark.read.option("basePath", f"{store}/{name}").parquet(*(f"{store}/{name}/attempt={r.attempt}" for r in rows))
    return read.withColumn("attempt", F.col("attempt").cast("string")).join(F.broadcast(order), "attempt").drop("attempt")  # a row for each live commit
