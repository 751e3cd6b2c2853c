"""Ordered look-back over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Column of rows that lie by it: a struct of some keys and the block.
PLACE = "__place"


def look_back(
    rows: DataFrame,
    keys: list[str],
    block: Column,
    order: list[str],
    value: str,
    weight: str,
    default: Column,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Add ``previous`` (``value`` of the row before) and ``before`` (sum of ``weight`` so far).

    The result is that of a window over ``keys`` ordered by ``order``, but no
    task holds a whole group: ``block`` (which must not decrease along
    ``order``) cuts every group into runs, a window works inside the runs, and
    the last row of a run carries its value and the weight so far into the next
    run.

    ``order`` should name every column but the keys and the weight.  Then both
    the rows and the last rows read the same shuffle, by run, and only the
    last rows move again.

    Rows with a column ``__place``, a struct of some keys and the block, lie by
    it already and stay there.  ``kept`` names groups by some of their keys;
    rows of others go, which are told apart by the last rows of their runs.
    """
    # Structs, so that missing key values compare equal and one hash serves all steps.
    if PLACE in rows.columns:
        rest = [key for key in keys if key not in rows.schema[PLACE].dataType.names]
        runs = rows.withColumn("__rest", F.struct(*rest)).drop(*rest)
        run, at = [PLACE, "__rest"], {key: F.col(f"{'__rest' if key in rest else PLACE}.{key}") for key in keys}
        names = [*keys, *[name for name in rows.columns if name not in (PLACE, *rest)]]
    else:
        key = F.struct(*keys, block.alias("block")).alias("__run")
        runs = rows.select(key, "*").drop(*keys).repartition("__run")
        run, at = ["__run"], {key: F.col(f"__run.{key}") for key in keys}
        names = rows.columns
    inside = Window.partitionBy(*run).orderBy(*order)
    detail = runs.withColumns(
        {
            "__nth": F.row_number().over(inside),
            "__previous": F.lag(value).over(inside),
            "__before": F.coalesce(
                F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "__ends": F.lead(F.lit(False), 1, True).over(inside),
        }
    )
    ends = detail.filter("__ends").select(
        *run,
        F.struct(*[column.alias(key) for key, column in at.items()]).alias("__group"),
        (F.col("__before") + F.col(weight)).alias("__weight"),
        F.col(value).alias("__last"),
    )
    group = ["__group"]
    if kept is not None:
        # The last rows then lie by those keys, for the window as well.
        ends = ends.withColumn("__key", F.struct(*[F.col(f"__group.{key}") for key in kept.columns]))
        ends = ends.join(kept.select(F.struct(*kept.columns).alias("__key")), "__key", "left_semi")
        group = ["__key", "__group"]
    across = Window.partitionBy(*group).orderBy(f"{run[0]}.block")
    carried = ends.select(
        *run,
        F.sum("__weight").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("__offset"),
        F.lag("__last").over(across).alias("__carried"),
    )
    opening = F.when(F.col("__offset").isNull(), default).otherwise(F.col("__carried"))
    return detail.join(carried, run).select(
        *[at[name].alias(name) if name in keys else name for name in names],
        F.when(F.col("__nth") == 1, opening).otherwise(F.col("__previous")).alias("previous"),
        (F.coalesce("__offset", F.lit(0)) + F.col("__before")).alias("before"),
    )
