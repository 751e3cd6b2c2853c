"""Index run: series and catalogue from the quotation file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelane.operators import index
from tidelane.sources.sinks import overwrite, read_keyed, replace_keyed, write_keyed

SERIES_INTERVAL = [*index.SERIES, "interval"]


def build_indices(spark: SparkSession, quotes: DataFrame, root: str, buckets: int = 8) -> None:
    """Write the index series, replacing what is there."""
    write_keyed(index.mi_sum(quotes), f"{root}/MI_SUM", SERIES_INTERVAL, buckets)


def refresh_indices(spark: SparkSession, quotes: DataFrame, root: str, buckets: int = 8) -> None:
    """Replace the series that ``quotes`` covers and leave the others."""
    fresh = index.mi_sum(quotes)
    replaced = fresh.select(*SERIES_INTERVAL)
    replace_keyed(spark, f"{root}/MI_SUM", fresh, replaced, buckets)


def build_series(spark: SparkSession, quotes: DataFrame, root: str, buckets: int = 8) -> None:
    """Write the rows of all series, so that new quotes can be added to them."""
    write_keyed(index.mi_sum_rows(quotes), f"{root}/MI_ROWS", index.LOOK_BACK, buckets)


def add_quotes(spark: SparkSession, quotes: DataFrame, new: DataFrame, root: str, buckets: int = 8) -> None:
    """Bring the stored series up to date with the ``new`` ones among ``quotes``.

    Only the hash buckets of touched series are read and rewritten. Adding quotes
    again changes nothing, so a run that died is repeated.
    """
    path = f"{root}/MI_ROWS"
    series = index.touched_buckets(new).select(*index.LOOK_BACK).distinct()
    updated = index.mi_sum_updated(read_keyed(spark, path, series), quotes, new)
    replace_keyed(spark, path, updated, series, buckets)


def build_catalogue(indices: DataFrame, week_detail: DataFrame, root: str) -> None:
    """Write the catalogue from stored series and stored week details."""
    overwrite(index.idx_lst(indices, week_detail), f"{root}/IDX_LST")
