"""Line dedup by levelled sorted runs of line hashes.

A *run* is a table of line hashes with the number of documents that hold each, sorted by hash and
cut into files by hash range. ``LineRuns`` keeps runs in levels: a batch adds a run to level 0, and
as soon as a level holds ``fan_in`` runs they are merged into one run of the next level. Runs are
never changed; the list of runs is one small table that is written last, so a job that dies leaves
the former state, and work repeated after that starts from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelane.llm.common import BLANKS, ascii_lower, shared_path, stored

_RUN = "hash long, n_docs long"


class LineRuns:
    """Runs in the folder ``path`` (shared by all executors), newest list of runs first."""

    def __init__(self, spark: SparkSession, path: str, *, fan_in: int = 2):
        self.spark, self.path, self.fan_in = spark, path, fan_in
        self.runs: list[tuple[int, str]] = []
        self.version = 0

    @staticmethod
    def open(spark: SparkSession, path: str, version: int, *, fan_in: int = 2) -> "LineRuns":
        """The state that ``version`` batches have left."""
        out = LineRuns(spark, path, fan_in=fan_in)
        rows = spark.read.schema("level int, run string").json(f"{path}/list-{version}").collect()
        out.runs, out.version = [(r.level, r.run) for r in rows], version
        return out

    def counts(self) -> DataFrame:
        """All hashes with their document counts, over all runs."""
        if not self.runs:
            return self.spark.createDataFrame([], _RUN)
        return _merged([self._read(run) for _, run in self.runs])

    def known(self, least: int) -> DataFrame:
        """Hashes that at least ``least`` documents hold so far."""
        return self.counts().filter(F.col("n_docs") >= least).select("hash")

    def add(self, counts: DataFrame) -> None:
        """Adds a batch's ``hash``, ``n_docs`` as a run, merges full levels, then writes the list."""
        level, runs = 0, [*self.runs, (0, self._write(counts))]
        while len(full := [r for r in runs if r[0] == level]) >= self.fan_in:
            merged = self._write(_merged([self._read(run) for _, run in full]))
            runs = [r for r in runs if r[0] != level] + [(level + 1, merged)]
            level += 1
        self.spark.createDataFrame(runs, "level int, run string").coalesce(1).write.json(f"{self.path}/list-{self.version + 1}")
        self.runs, self.version = runs, self.version + 1

    def _read(self, run: str) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(run)

    def _write(self, counts: DataFrame) -> str:
        run = shared_path(self.spark, "line-run")
        counts.select("hash", "n_docs").repartitionByRange("hash").sortWithinPartitions("hash").write.parquet(run)
        return run


def _merged(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs).groupBy("hash").agg(F.sum("n_docs").alias("n_docs"))


def lines_of(text: Column) -> Column:
    """The lines of a text, cut at each newline; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column, least_length: int) -> Column:
    """A 64-bit hash per line of its key (blanks stripped, A-Z lower-cased); null for shorter keys."""
    keys = F.transform(lines_of(ascii_lower(text)), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.transform(keys, lambda k: F.when(F.length(k) >= least_length, F.xxhash64(k)))


def drop_frequent_lines(
    docs: DataFrame, *, least_docs: int = 10, least_length: int = 1, batches: int = 4, fan_in: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``text`` rid of lines whose key at least ``least_docs`` documents hold, ``n_lines``, ``n_dropped``.

    Documents come in ``batches``, dealt by a hash of their text. Each merge-anti-joins the runs: keys
    that are frequent already are settled, and only the others are added as a run. All documents
    are then held against the frequent keys of all runs. Each row is a document, rows with equal or
    null ids, too; a key counts once per row. Null and empty texts are one empty line, which has
    an empty key: such keys are dropped only with ``least_length`` 0. An empty table gives no rows.
    Other columns stay; columns named ``n_lines`` and ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Names that no column of the documents has.
    own = "line"
    while any(name.lower().startswith(own) for name in docs.columns):
        own += "_"
    key, mark, out_key, out_mark, gone = (f"{own}_{x}" for x in ("key", "mark", "out_key", "out_mark", "gone"))
    row = {key: F.col(id_col), mark: F.xxhash64(text)}
    hashed = docs.select(
        *[v.alias(k) for k, v in row.items()],
        F.array_compact(F.array_distinct(line_hashes(text, least_length))).alias("hashes"),
    ).withColumn("batch", F.pmod(mark, F.lit(batches)).cast("int"))
    hashed = stored(hashed, "line-hashes")
    runs = LineRuns(spark, shared_path(spark, "line-runs"), fan_in=fan_in)
    for batch in range(batches):
        new = hashed.filter(F.col("batch") == batch).select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n_docs"))
        runs.add(new.join(runs.known(least_docs), "hash", "left_anti") if runs.runs else new)
    frequent = stored(runs.known(least_docs), "line-frequent")
    out = (
        hashed.select(key, mark, F.explode("hashes").alias("hash")).join(frequent, "hash")
        .groupBy(key, mark).agg(F.collect_set("hash").alias(gone))
    )
    right = out.select(F.col(key).alias(out_key), F.col(mark).alias(out_mark), gone)
    joined = docs.withColumns(row).join(
        right, (F.col(mark) == F.col(out_mark)) & F.col(key).eqNullSafe(F.col(out_key)), "left"
    )
    drops = F.coalesce(F.transform(line_hashes(text, least_length), lambda h: F.coalesce(F.array_contains(gone, h), F.lit(False))), F.array())
    lines = lines_of(text)
    kept = F.array_join(F.filter(F.arrays_zip(lines.alias("line"), drops.alias("drop")), lambda x: ~x["drop"])["line"], "\n")
    return joined.withColumns(
        {
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.filter(drops, lambda d: d))).cast("long"),
            text_col: F.when(F.col(gone).isNull(), F.col(text_col).cast("string")).otherwise(kept),
        }
    ).drop(key, mark, out_key, out_mark, gone)
