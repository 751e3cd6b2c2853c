"""Readers: JDBC, parquet, CSV, inline rows, temp views, typed empty frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelane.schemas import TABLES


class HeaderError(ValueError):
    """A file's header line names other columns than expected."""


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    bounds: tuple[int, int],
    partitions: int,
    column: str = "ID",
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan split into ranges of ``column``.

    ``bounds`` only place the split points; rows outside them are still read.
    """
    low, high = bounds
    return {
        **properties,
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def id_bounds_query(table: str, column: str = "ID") -> str:
    """Query for the split points, answered by the database."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def id_histogram_query(table: str, column: str, low: int, width: int) -> str:
    """Query for the number of rows per ``width`` ids, answered by the database: at most a row per cell in use."""
    cell = f"FLOOR(({column} - {low}) / {width})"
    return f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {cell}"


def quantile_cuts(cells: Mapping[int, int], low: int, width: int, partitions: int) -> list[int]:
    """Ids that part the rows of a histogram into at most ``partitions`` ranges of about equal size.

    A range ends with the cell in which its share of the rows is reached, so a gap in the ids costs
    nothing and one crowded cell is a range of its own.
    """
    total, share, held, cuts = sum(cells.values()), 1, 0, []
    for cell in sorted(cells):
        held += cells[cell]
        if held * partitions >= share * total:
            cuts.append(low + (cell + 1) * width)
            share = held * partitions // total + 1
    return cuts[:-1]


def split_predicates(column: str, cuts: list[int]) -> list[str]:
    """Conditions, one per task, of which every row meets exactly one; a null id goes with the least."""
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partitions: int,
    column: str = "ID",
    cells: int = 64,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Table over JDBC, read by about ``partitions`` tasks with about equally many rows each.

    The database counts its rows in ``cells`` times ``partitions`` equal widths of ``column``; the
    tasks' ranges are cut by those counts, not by the widths.
    """
    source = spark.read.format("jdbc").options(**properties).option("url", url)
    row = source.option("query", id_bounds_query(table, column)).load().first()
    cuts: list[int] = []
    if row is not None and row[0] is not None:
        low, high = int(row[0]), int(row[1])
        width = max(1, -(-(high - low + 1) // (cells * partitions)))
        counted = source.option("query", id_histogram_query(table, column, low, width)).load()
        # At most ``cells`` times ``partitions`` counts.
        cuts = quantile_cuts({int(r[0]): int(r[1]) for r in counted.collect()}, low, width, partitions)
    given = {**properties, "fetchsize": str(fetch_rows)}
    return spark.read.jdbc(url, table, predicates=split_predicates(column, cuts), properties=given)


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    schema: str,
    names: Iterable[str],
    properties: Mapping[str, str],
    partitions: int,
) -> dict[str, DataFrame]:
    """Several tables of one database schema, by name."""
    return {
        name: read_jdbc(spark, url, f"{schema}.{name}", properties, partitions) for name in names
    }


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line; a header of other columns, or a malformed line, is an error."""
    check_header(spark, path, schema)
    return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


def read_csv_parts(spark: SparkSession, path: str, schema: StructType, corrupt: str = "corrupt_line") -> tuple[DataFrame, DataFrame]:
    """The well-formed rows of a CSV with a header line, and its malformed lines as texts.

    Every line comes in one of the two: a line with a field that its type can't hold, or with too
    many or too few fields, is kept as it was, in the column ``corrupt``, and none of its fields
    turns to null. The header is checked first.
    """
    check_header(spark, path, schema)
    wider = StructType([*schema.fields, StructField(corrupt, StringType())])
    # No line breaks within fields, so that large files can be split.
    lines = spark.read.schema(wider).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt).csv(path)
    # Malformed is what some field finds so, so all fields are asked for; the comparison holds for every row.
    lines = lines.filter(F.xxhash64(*schema.names) >= F.lit(-(1 << 63)))
    good = lines.filter(F.col(corrupt).isNull()).select(*schema.names)
    return good, lines.filter(F.col(corrupt).isNotNull()).select(corrupt)


def check_header(spark: SparkSession, path: str, schema: StructType) -> None:
    """Raise ``HeaderError`` unless each file's first line names the columns of ``schema``, in order."""
    wanted = list(schema.names)
    named = spark.read.format("csv").option("header", True).option("inferSchema", False).load(path).columns
    if named != wanted:
        raise HeaderError(f"columns {named} instead of {wanted} in {path}")


def quarantined(bad: DataFrame, path: str, source: str) -> int:
    """Add malformed lines to a table of such, with the source's name; how many there were."""
    bad.select(F.lit(source).alias("source"), F.current_timestamp().alias("readAt"), "*").write.mode("append").parquet(path)
    return bad.count()


def read_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Source tables kept as parquet folders under ``root``, any file system Spark knows."""
    return {name: read_parquet(spark, f"{root}/{name}", TABLES[name]) for name in names}


def footer_marks(spark: SparkSession, root: str, names: Iterable[str], column: str = "ID") -> DataFrame:
    """Highest ``column`` per table kept as parquet, as ``tableName``, ``maxId``, from the files' statistics.

    The aggregate is pushed down to the file footers, so no row is read. That is a setting of the
    scan, so the question is put in a session of its own; one number per table comes back.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    marks = [(name, max_of_files(own, f"{root}/{name}", TABLES[name], column).first()[0]) for name in names]
    return spark.createDataFrame([(name, None if mark is None else int(mark)) for name, mark in marks], "tableName string, maxId long")


def max_of_files(spark: SparkSession, path: str, schema: StructType, column: str) -> DataFrame:
    """The highest ``column`` of parquet files."""
    return spark.read.schema(schema).parquet(path).agg(F.max(column))


def inline(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Frame without rows whose columns can be named."""
    return spark.createDataFrame([], schema)


def or_empty(tables: Mapping[str, DataFrame], name: str, spark: SparkSession) -> DataFrame:
    """A table, or a typed empty frame when it is missing."""
    return tables[name] if name in tables else empty(spark, TABLES[name])


def register(tables: Mapping[str, DataFrame], cached: bool = False) -> None:
    """Make tables available to SQL under their names; ``cached`` keeps them in memory and on disk.

    ``DataFrame.unpersist`` on the registered table lets it go again.
    """
    for name, table in tables.items():
        kept = table.persist(StorageLevel.MEMORY_AND_DISK) if cached else table
        kept.createOrReplaceTempView(name)


def registered(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    """Registered tables as frames."""
    return {name: spark.table(name) for name in names}
