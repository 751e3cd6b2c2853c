"""Writers: collections on parquet, keyed replacement, JSON messages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from itertools import islice
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidelane.functions.values import null_safe_join
from tidelane.operators.changes import upsert_by_key
from tidelane.sources.files import Folder

Sender = Callable[[str, str], None]

BUCKETS = 64


def overwrite(frame: DataFrame, path: str) -> None:
    """Replace a collection."""
    frame.write.mode("overwrite").parquet(path)


def append(frame: DataFrame, path: str) -> None:
    """Add to a collection."""
    frame.write.mode("append").parquet(path)


def json_documents(frame: DataFrame) -> DataFrame:
    """One JSON document per row, as column ``value``."""
    return frame.select(F.to_json(F.struct("*")).alias("value"))


def json_messages(documents: Iterable[Row], rows_per_message: int) -> Iterable[str]:
    """JSON arrays of at most ``rows_per_message`` documents each."""
    source = iter(documents)
    while batch := list(islice(source, rows_per_message)):
        yield "[" + ",".join(row.value for row in batch) + "]"


def publish(frame: DataFrame, topic: str, send: Sender, rows_per_message: int = 500) -> None:
    """Send every row as JSON, from the executors; ``send(topic, text)`` is the caller's."""

    def send_partition(documents: Iterable[Row]) -> None:
        for message in json_messages(documents, rows_per_message):
            send(topic, message)

    json_documents(frame).foreachPartition(send_partition)


@dataclass(frozen=True)
class State:
    """One version of a keyed collection: which generation holds each hash bucket of its keys."""

    version: int
    keys: list[str]
    buckets: int
    generations: dict[int, str]

    @staticmethod
    def of(text: str) -> State:
        given = json.loads(text)
        return State(**{**given, "generations": {int(bucket): name for bucket, name in given["generations"].items()}})


def write_keyed(frame: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write a collection whose rows can later be replaced by ``keys``; all it held before goes."""
    everything = list(range(buckets))
    generation = _write_buckets(frame, path, keys, buckets, everything)
    spark = frame.sparkSession
    while True:
        newest = state_of(spark, path)
        version = newest.version + 1 if newest else 0
        if _add(spark, path, State(version, keys, buckets, dict.fromkeys(everything, generation))):
            return


def read_keyed(spark: SparkSession, path: str, touched: DataFrame | None = None) -> DataFrame:
    """Rows of a collection written by ``write_keyed``.

    ``touched`` lists keys (the columns the collection is keyed by): only their rows come, and only
    their hash buckets are read. A null key matches a null key.
    """
    state = state_of(spark, path)
    if touched is None:
        return _read_buckets(spark, path, state, sorted(state.generations))
    wanted = _touched(touched.select(*state.keys), state)
    rows = _read_buckets(spark, path, state, wanted or [0])
    return null_safe_join(rows, touched.select(*state.keys), state.keys, "left_semi") if wanted else rows.filter(F.lit(False))


def replace_keyed(
    spark: SparkSession, path: str, fresh: DataFrame, replaced: DataFrame, buckets: int = BUCKETS
) -> None:
    """Replace the rows of the ``replaced`` keys by ``fresh``.

    Only the hash buckets that hold a replaced key are read and rewritten, as a new generation.
    Readers follow the newest version file, which is added last; a job that dies before leaves the
    collection as it was.  Running it twice leaves the same collection, so a batch may be replayed.
    Two may replace at a time: a version file is only ever added under a free name, and who finds
    it taken goes on from the other's version, merging again where both touched a bucket.
    ``replaced`` has the columns the collection is keyed by, and ``fresh`` only rows of those keys.
    A collection keeps the number of buckets it was written with; ``buckets`` counts for a new one.
    """
    keys = replaced.columns
    while True:
        state = state_of(spark, path)
        if state is None:
            generation = _write_buckets(fresh, path, keys, buckets, list(range(buckets)))
            if _add(spark, path, State(0, keys, buckets, dict.fromkeys(range(buckets), generation))):
                return
            continue
        touched = _touched(replaced, state)
        if not touched:
            return
        stored = _read_buckets(spark, path, state, touched)
        merged = upsert_by_key(stored, fresh, replaced, null_keys=True)
        generation = _write_buckets(merged, path, keys, state.buckets, touched)
        if _commit(spark, path, state, touched, generation):
            return


def drop_old(spark: SparkSession, path: str, keep: int = 1, older_than: float = 0) -> None:
    """Delete version files but the ``keep`` newest, and buckets that those don't name.

    Buckets younger than ``older_than`` seconds stay: a writer may be about to name them. A reader
    that still follows an older version needs the files of that version, so ``keep`` and
    ``older_than`` should outlast the longest job.
    """
    manifest, data = Folder(spark, f"{path}/manifest"), Folder(spark, f"{path}/data")
    versions = [name for name in manifest.names() if name.endswith(".json")]
    kept = set()
    for name in versions[-keep:]:
        kept |= {(generation, f"bucket={bucket}") for bucket, generation in State.of(manifest.text(name)).generations.items()}
    for generation, age in data.ages().items():
        if age < older_than:
            continue
        folder = Folder(spark, f"{path}/data/{generation}")
        buckets = [name for name in folder.names() if name.startswith("bucket=")]
        unused = [name for name in buckets if (generation, name) not in kept]
        for name in unused:
            folder.remove(name)
        if len(unused) == len(buckets):
            folder.remove()
    for name in versions[:-keep]:
        manifest.remove(name)


def state_of(spark: SparkSession, path: str) -> State | None:
    """Newest version of a collection, or None where there is no collection."""
    manifest = Folder(spark, f"{path}/manifest")
    versions = [name for name in manifest.names() if name.endswith(".json")]
    return State.of(manifest.text(versions[-1])) if versions else None


def _add(spark: SparkSession, path: str, state: State) -> bool:
    """Add a version file; false if another writer has added that version."""
    return Folder(spark, f"{path}/manifest").add(f"v{state.version:012d}.json", json.dumps(asdict(state)))


def _commit(spark: SparkSession, path: str, read: State, touched: list[int], generation: str) -> bool:
    """Name the ``touched`` buckets' new generation; false if one of them changed since ``read``."""
    while True:
        newest = state_of(spark, path)
        same = newest.buckets == read.buckets and all(newest.generations[b] == read.generations[b] for b in touched)
        if not same:
            return False
        generations = {**newest.generations, **dict.fromkeys(touched, generation)}
        if _add(spark, path, State(newest.version + 1, newest.keys, newest.buckets, generations)):
            return True


def _touched(keys: DataFrame, state: State) -> list[int]:
    """Buckets of the given keys: at most ``buckets`` numbers."""
    marked = keys.select(_bucket(state.keys, state.buckets)).distinct()
    return sorted(row.bucket for row in marked.collect())


def _read_buckets(spark: SparkSession, path: str, state: State, wanted: list[int]) -> DataFrame:
    folders = [f"{path}/data/{state.generations[bucket]}/bucket={bucket}" for bucket in wanted]
    return spark.read.parquet(*folders).filter("live").drop("live")


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _write_buckets(frame: DataFrame, path: str, keys: list[str], buckets: int, touched: list[int]) -> str:
    """Write the ``touched`` buckets as a new generation, which no version names yet."""
    spark, generation = frame.sparkSession, uuid4().hex
    placed = frame.select("*", F.lit(True).alias("live"), _bucket(keys, buckets))
    # A row that is not live makes a folder even for a bucket without others.
    marks = spark.createDataFrame([(bucket, False) for bucket in touched], "bucket int, live boolean")
    # Rebalancing gathers a bucket's rows, but splits a bucket too large for one task.
    (
        placed.unionByName(marks, allowMissingColumns=True)
        .hint("rebalance", "bucket")
        .write.partitionBy("bucket")
        .parquet(f"{path}/data/{generation}")
    )
    return generation
