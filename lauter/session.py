"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime-changeable settings every job in this package is designed for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits the hot side of a lookup join when one key holds most of the rows
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # accepted and rejected rows are written in one pass without sorting on the flag
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # the JVM never compiles methods above 8000 bytes of code; a stage whose fused
    # method would be larger runs operator by operator, which is far faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # rows that go to Python are counted by bytes too: 10,000 long texts at once, with their
    # copies as Python objects, would take a worker some hundred MB and more for longer texts
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # a repeated JSON key keeps its last value instead of making the line malformed
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Settings that must be given when a session is built.
BUILD_SETTINGS = {
    # plans here are made of many small expressions; recording the Python call
    # site of each one doubles the time to build them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(builder: SparkSession.Builder | None = None) -> SparkSession:
    """A session with all settings of this module."""
    builder = builder or SparkSession.builder
    for key, value in {**BUILD_SETTINGS, **SETTINGS}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Spark keeps the shuffle files of a job that is done until the JVM's garbage collector finds it
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every query run meanwhile as soon as it has ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    fallback = tempfile.mkdtemp(prefix="lauter-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/lauter/{label}-{uuid.uuid4().hex}"
