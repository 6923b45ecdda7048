"""Session helpers: local sessions for tests, the shared scratch folder of a cluster, and the package on executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(app: str, cores: int | None = None, memory: str | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory or "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _single_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Where no such folder is named the session must run in one process (tests), and a temporary folder,
    removed when the process ends, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _single_process(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
        base = tempfile.mkdtemp(prefix="lumisift-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession, _sent: set[str] = set()) -> None:  # noqa: B006
    """Make this package importable on executors that do not have it; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lumisift-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "lumisift.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.join("lumisift", os.path.relpath(full, here)))
    context.addPyFile(path)
