"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the JIT leaves methods beyond 8000 bytes interpreted; wide tables then run as smaller methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # joins whose smaller side comes in partitions of this size at most hash that side instead of sorting both
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.ui.enabled": "false",
}
#: Those that make much difference while cleaned tables are made.
STORING = {k: SETTINGS[k] for k in ("spark.sql.codegen.hugeMethodLimit", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemerge")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def with_settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for a while, as far as the session does not name its own."""
    missing = {k: v for k, v in values.items() if spark.conf.get(k, None) is None}
    for key, value in missing.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it; in a local session without one, a new folder."""
    context = spark.sparkContext
    name = "spark.checkpoint.dir"
    folder = spark.conf.get(name, None) or context.getConf().get(name) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"{name} is not set: name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemerge-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
