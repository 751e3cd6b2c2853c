"""Nested result documents: key columns plus an ordered array of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A document array stays well below the size limit of one row.
PAGE_ROWS = 100_000


def nest(
    rows: DataFrame,
    keys: list[str],
    fields: list[str],
    cell: str = "Cell",
    repeated: bool = False,
) -> DataFrame:
    """Fold ``rows`` into one sorted array of distinct structs per ``keys``.

    For groups whose size is bounded by the calendar or by a code list.  Say
    ``repeated`` if the rows may hold duplicates.
    """
    collected = F.collect_set if repeated else F.collect_list
    return rows.groupBy(*keys).agg(F.sort_array(collected(F.struct(*fields))).alias(cell))


def nest_pages(
    rows: DataFrame, keys: list[str], fields: list[str], number: str, cell: str = "Cell"
) -> DataFrame:
    """``nest`` with a document per month of the offer numbers in the column ``number``.

    The page is read off the row itself, so the layout of a group does not depend on its size.
    """
    return nest(rows.withColumn("page", month_page(F.col(number))), [*keys, "page"], fields, cell)


def nest_ranked(
    rows: DataFrame,
    keys: list[str],
    fields: list[str],
    number: str,
    page_rows: int,
    cell: str = "Cell",
) -> DataFrame:
    """``nest`` with full pages: the rows of a group in order of ``number``, ``page_rows`` to a page.

    Cells lie in that order, then in that of ``fields``.  See ``ranked`` for how rows are numbered.
    """
    order = [number, *[name for name in fields if name != number]]
    paged = ranked(rows, keys, order, number).withColumn(
        "page", F.floor(F.col("rank") / page_rows).cast("int")
    )
    # The rank alone orders a page, so that its cells are collected once.
    entry = F.struct("rank", F.struct(*fields).alias("cell"))
    cells = F.transform(F.sort_array(F.collect_list(entry)), lambda item: item.cell)
    return paged.groupBy(*keys, "page").agg(cells.alias(cell))


def ranked(rows: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """Add ``rank``: the place of a row in its group, from 0, by ``order``, which starts with ``number``.

    No task holds a whole group.  Rows are made once: they move to the place of their offer, where they
    are counted and numbered, and only the counts of offers move further.  The minute an offer was placed, read off
    its number, cuts a group into runs; offers are counted within runs, the runs' sizes are added up
    within months and the months' within the group, so that a sum is over the offers of a minute, the
    minutes of a month or over months.
    """
    # Its place keeps a row whole: the columns that are counted stay behind the shuffle, which is then the same for all.
    whole = F.struct(*rows.columns, F.monotonically_increasing_id().alias("__place")).alias("__row")
    moved = rows.withColumn("__offer", F.struct(number)).repartition("__offer").select("__offer", whole).select("__offer", "__row.*").drop("__place")
    # By offer first: rows stay there, and so do the counts of their offers.
    inside = Window.partitionBy("__run", *keys).orderBy(*order)
    placed = moved.withColumnRenamed("__offer", "__run").withColumn("__nth", F.row_number().over(inside))
    minute, month = (F.coalesce(F.substring(number, 1, size), F.lit("")) for size in (13, 7))
    counts = moved.groupBy("__offer", number, *keys).agg(F.count(F.lit(1)).alias("__size")).select(
        F.struct(*keys, F.lit(0).alias("all")).alias("__group"),
        month.alias("__month"),
        minute.alias("__minute"),
        F.col("__offer").alias("__number"),
        "__size",
    )
    run = ["__group", "__month", "__minute"]
    within = Window.partitionBy(*run).orderBy("__number")
    offers = counts.withColumn("__inside", _before("__size", within))
    sizes = counts.groupBy(*run).agg(F.sum("__size").alias("__size"))
    minutes = sizes.withColumn("__earlier", _before("__size", Window.partitionBy(*run[:2]).orderBy("__minute")))
    months = sizes.groupBy(*run[:2]).agg(F.sum("__size").alias("__size"))
    opening = months.withColumn("__opening", _before("__size", Window.partitionBy("__group").orderBy("__month")))
    starts = (
        offers.drop("__size")
        .join(minutes.drop("__size"), run)
        .join(opening.drop("__size"), run[:2])
        .select(
            "__number",
            "__group",
            (F.col("__opening") + F.col("__earlier") + F.col("__inside")).alias("__start"),
        )
    )
    same = (F.col("__run") == F.col("__number")) & (F.struct(*keys, F.lit(0).alias("all")) == F.col("__group"))
    # Rows without a number are an offer of their own, the first of their group.
    return placed.join(starts, same).select(*rows.columns, (F.col("__start") + F.col("__nth") - 1).alias("rank"))


def _before(value: str, ordered: Window) -> Column:
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def month_page(offer_number: Column) -> Column:
    """Year and month that an offer number starts with after its letter, or 0."""
    return F.coalesce(F.substring(offer_number, 2, 6).try_cast("int"), F.lit(0))


def flatten(documents: DataFrame, cell: str = "Cell") -> DataFrame:
    """Back from documents to one row per array element."""
    keys = [name for name in documents.columns if name not in (cell, "page")]
    return documents.select(*keys, F.explode(cell).alias("__cell")).select(*keys, "__cell.*")


def joined_field(cell: str, field: str) -> Column:
    """One field of all array elements as a comma-separated string."""
    return F.array_join(F.transform(cell, lambda item: item[field].cast("string")), ",")
