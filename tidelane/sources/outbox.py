"""Messages that are sent once: numbered, kept until sent, and skipped when a run is repeated.

A batch's messages are written before any is sent, so a repeated run sends the same texts under the
same numbers. What was sent is kept beside them. A sender that fails ends its task's part; what its
task sent before is kept all the same, and the next delivery goes on behind it. A machine that is
lost takes with it only the record of the messages its running task had sent; their numbers, which
the sender gets, let a receiver tell such a repetition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelane.sources.files import Folder

#: Topic, message id ("batch/number") and text; raises when a message can't be sent.
NumberedSender = Callable[[str, str, str], None]

_MESSAGES = "number long, topic string, text string"
_ATTEMPTS = "number long, error string"


class UndeliveredError(RuntimeError):
    """Some messages of a batch were not sent; delivering the batch again sends only those."""


def enqueue(frame: DataFrame, root: str, batch: str, topic: str, keys: list[str], rows_per_message: int = 500) -> None:
    """Write the messages of a batch: JSON arrays of up to ``rows_per_message`` rows each.

    Rows are dealt to messages by a hash of their ``keys`` and ordered within them, so equal rows
    make equal messages wherever they are made. A batch that is there already stays as it is.
    """
    spark = frame.sparkSession
    if "_SUCCESS" in Folder(spark, f"{root}/messages/batch={batch}").names():
        return
    document = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    # Cells of about a message's rows: the number of cells follows the number of rows.
    cells = max(1, -(-frame.count() // rows_per_message))
    cell = F.pmod(F.xxhash64(*keys), F.lit(cells))
    rows = frame.select(cell.alias("cell"), document.alias("document"))
    within = Window.partitionBy("cell").orderBy("document")
    parts = rows.withColumn("part", F.floor((F.row_number().over(within) - 1) / rows_per_message))
    text = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("document")), ","), F.lit("]"))
    grouped = parts.groupBy("cell", "part").agg(text.alias("text"))
    # A cell and its part make the number; no cell has as many parts as there are rows in all.
    number = F.col("cell") * (1 << 32) + F.col("part")
    messages = grouped.select(number.alias("number"), F.lit(topic).alias("topic"), "text")
    messages.write.mode("overwrite").parquet(f"{root}/messages/batch={batch}")


def pending(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """Messages of a batch that no delivery has sent yet."""
    messages = spark.read.schema(_MESSAGES).parquet(f"{root}/messages/batch={batch}")
    done = _attempts(spark, root, batch)
    return messages if done is None else messages.join(done.filter("error IS NULL"), "number", "left_anti")


def deliver(spark: SparkSession, root: str, batch: str, send: NumberedSender, tasks: int = 16) -> int:
    """Send what is pending of a batch, from the executors; how many messages were sent.

    Raises ``UndeliveredError`` if a sender failed, after what was sent has been recorded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            numbers, errors = [], []
            for number, topic, text in zip(*(rows[c].to_pylist() for c in ("number", "topic", "text")), strict=True):
                numbers.append(number)
                try:
                    send(topic, f"{batch}/{number}", text)
                    errors.append(None)
                except Exception as error:  # noqa: BLE001  (whatever a sender raises is kept, not lost)
                    errors.append(repr(error))
                    break
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(errors, pa.string())], ["number", "error"])
            if errors and errors[-1] is not None:
                return

    waiting = pending(spark, root, batch)
    attempt = str(len(Folder(spark, f"{root}/attempts/batch={batch}").names()))
    path = f"{root}/attempts/batch={batch}/attempt={attempt}"
    waiting.repartition(tasks, "number").mapInArrow(run, _ATTEMPTS).write.parquet(path)
    made = spark.read.schema(_ATTEMPTS).parquet(path)
    sent, failed = made.agg(F.count_if(F.col("error").isNull()), F.first("error", ignorenulls=True)).first()
    if failed is not None:
        raise UndeliveredError(failed)
    return sent


def forget(spark: SparkSession, root: str, batch: str) -> None:
    """Delete a batch's messages and records, once nothing repeats it."""
    Folder(spark, f"{root}/messages/batch={batch}").remove()
    Folder(spark, f"{root}/attempts/batch={batch}").remove()


def _attempts(spark: SparkSession, root: str, batch: str) -> DataFrame | None:
    """Records of all finished deliveries of a batch."""
    folder = f"{root}/attempts/batch={batch}"
    names = [name for name in Folder(spark, folder).names() if "_SUCCESS" in Folder(spark, f"{folder}/{name}").names()]
    return spark.read.schema(_ATTEMPTS).parquet(*[f"{folder}/{name}" for name in names]) if names else None
