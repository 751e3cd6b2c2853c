"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidelane.sources.files import Folder

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def session(app_name: str, **settings: str) -> SparkSession:
    """Session with the engine's settings; ``settings`` go on top."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a frame to the shared folder and reads it again; all of it goes in the end."""
    root = scratch(spark, name)

    def kept(frame: DataFrame, part: str) -> DataFrame:
        frame.write.parquet(f"{root}/{part}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{part}")

    try:
        yield kept
    finally:
        Folder(spark, root).remove()
