"""Small column expressions shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mean(value: Column) -> Column:
    """Average as exact sum over count, so decimals do not lose digits midway."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` where a null key equals a null key; one copy of the keys stays.

    The keys are compared as one struct, which is never null itself.
    """
    key = F.struct(*keys).alias("__key")
    return left.select("*", key).join(right.select(key, "*").drop(*keys), "__key", how).drop("__key")


def sampled(rows: DataFrame, keys: Iterable[str], fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, picked by a hash of their ``keys``.

    The same rows come at any partitioning, and rows with equal keys together.
    """
    hashed = F.conv(F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8), 16, 10).cast("long")
    return rows.filter(hashed < int(fraction * 16**8))


def cleaned(text: Column) -> Column:
    """Drop everything but letters, digits, underscore and hyphen."""
    return F.regexp_replace(text, "[^a-zA-Z0-9_-]", "")


def topic_name(document: Column) -> Column:
    """Route topic of a JSON document that carries ``polCode`` and ``podCode``."""
    # Topic prefix (market, terms, payment) and container suffix.
    return F.concat(
        F.lit("/topic/01_01_01_"),
        cleaned(F.get_json_object(document, "$.polCode")),
        F.lit("_"),
        cleaned(F.get_json_object(document, "$.podCode")),
        F.lit("_01"),
    )


#: Bytes, by the optimizer's estimate, up to which a side may be sent to every task.
SMALL = 32 << 20


def estimated_bytes(frame: DataFrame) -> int:
    """What the optimizer takes the frame's size to be; for files, at most what they hold."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized(frame: DataFrame, limit: int = SMALL) -> DataFrame:
    """The frame with a broadcast hint if it is surely small, and as it is otherwise."""
    return F.broadcast(frame) if estimated_bytes(frame) <= limit else frame
