"""Exact top-k search by tiled matrix products.

Vectors are packed into tiles, queries into blocks. Each tile meets each block once; of the product
of the two only the best ``k`` per query are kept (partial selection), lists of a task's tiles are
merged as they come, and a ranking per query merges the lists of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Vectors in a tile and in a block of queries.
TILE, BLOCK = 4096, 1024
#: Tiles and blocks that meet in one task, if they are full.
TILES, BLOCKS = 4, 16
_SAFE = 1 << 52
_LOWEST = np.iinfo(np.int64).min


def _matrices(frame: DataFrame, rows: int) -> DataFrame:
    """``ids`` and ``values`` (64-bit integers as bytes) of up to ``rows`` vectors of one ``dim`` and one task; ``task`` tells the task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, values = zip(*held.pop(dim), strict=True)
            columns = [pa.array([dim], pa.int32()), pa.array([task], pa.int32())]
            columns += [pa.array([np.concatenate(x).tobytes()]) for x in (ids, values)]
            return pa.RecordBatch.from_arrays(columns, ["dim", "task", "ids", "values"])

        task = 0
        for batch in batches:
            task = batch["task"][0].as_py() if batch.num_rows else task
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists, ids = part["vector"], part["id"].to_numpy()
                sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
                for dim in np.unique(sizes).tolist():
                    these = sizes == dim
                    held.setdefault(dim, []).append((ids[these], flat[np.repeat(these, sizes)]))
                    if sum(len(x) for x, _ in held[dim]) >= rows:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return frame.select("id", "vector", F.spark_partition_id().alias("task")).mapInArrow(scan, "dim int, task int, ids binary, values binary")


def _groups(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def _read(ids: pa.Scalar, values: pa.Scalar, dim: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids.as_buffer(), np.int64)
    return names, np.frombuffer(values.as_buffer(), np.int64).reshape(len(names), dim)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of 64-bit integers; sums beyond 64 bits wrap."""
    if a.shape[1] * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) < _SAFE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(query, vec, score, k: int) -> np.ndarray:
    """Places of each query's ``k`` highest scores, ties to the smaller vector id."""
    order = np.lexsort((vec, -score, query))
    sorted_ = query[order]
    first = np.searchsorted(sorted_, sorted_)
    return order[np.arange(len(order)) - first < k]


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's ``k`` highest inner products.

    ``vector_col`` holds arrays of whole numbers (long). Rows with a null id, a null vector or a
    vector holding null take no part; vectors meet only those of their length. A row with a
    query's own id is not among its candidates. Ties go to the smaller id. A query id that repeats
    is asked once, with its greatest vector; candidates that repeat are candidates each. Fewer than
    ``k`` candidates give all of them; an empty table gives no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession

    def clean(frame: DataFrame) -> DataFrame:
        frame = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<long>").alias("vector"))
        return frame.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))

    asked = clean(queries).groupBy("id").agg(F.max("vector").alias("vector"))
    n_asked = asked.count()
    blocks = _matrices(asked.coalesce(max(1, n_asked // BLOCK)), BLOCK)
    tiles = _matrices(clean(vectors), TILE).withColumnsRenamed({"ids": "tile_ids", "values": "tile"})
    # Each group of tiles meets each group of blocks in a task of its own. What a task read is in one group,
    # so that a task which runs again gives the same.
    across, down = _groups(vectors.count(), TILES * TILE), _groups(n_asked, BLOCKS * BLOCK)

    def dealt(frame: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        frame = frame.withColumn(own, F.pmod("task", F.lit(groups))).drop("task")
        return frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    met = dealt(tiles, "across", across, "down", down).join(dealt(blocks, "down", down, "across", across), ["dim", "across", "down"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3

        def merged(parts: list) -> list:
            query, vec, score = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep = _best(query, vec, score, k)
            return [query[keep], vec[keep], score[keep]]

        for batch in batches:
            for dim, tile_ids, tile, ids, values in zip(*(batch[c] for c in ("dim", "tile_ids", "tile", "ids", "values")), strict=True):
                vec, x = _read(tile_ids, tile, dim.as_py())
                query, q = _read(ids, values, dim.as_py())
                score = product(q, x) if dim.as_py() else np.zeros((len(query), len(vec)), np.int64)
                # A query's own rows, however many, come last before the selection, so that they take no place in it.
                score[query[:, None] == vec] = _LOWEST
                most = min(k, len(vec))
                # The k-th highest of a query and all that tie with it.
                least = np.partition(score, len(vec) - most, axis=1)[:, len(vec) - most]
                row, column = np.nonzero(score >= least[:, None])
                part = query[row], vec[column], score[row, column]
                other = part[0] != part[1]
                held = merged([held, [c[other] for c in part]])
                if len(held[0]) > 64 * BLOCK * k:
                    yield _lists(held)
                    held = [np.empty(0, np.int64)] * 3
        yield _lists(held)

    lists = met.select("dim", "tile_ids", "tile", "ids", "values").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _lists(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """Each component, as double, times ``scale`` and rounded down; null if one is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))
