"""Continuous market watch: new table files in, replaced documents out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelane.operators.changes import FEEDING
from tidelane.operators.fact import DEAL
from tidelane.plans.market_watch import Store, forget_messages, update_deals
from tidelane.schemas import TABLES
from tidelane.sources.readers import read_tables
from tidelane.sources.outbox import NumberedSender

STATIC = ["MDM_CRYR"]


def changed_deal_stream(spark: SparkSession, root: str, files_per_batch: int) -> DataFrame:
    """Deal keys of every new row in the feeding tables under ``root``."""
    streams = [
        spark.readStream.schema(TABLES[name])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{root}/{name}")
        .select(*DEAL)
        for name in FEEDING
    ]
    return reduce(DataFrame.unionByName, streams)


def run(
    spark: SparkSession,
    root: str,
    store: Store,
    current_week: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    available_now: bool = True,
    interval: str = "1 minute",
    send: NumberedSender | None = None,
) -> StreamingQuery:
    """Keep the market-watch collections up to date with the tables under ``root``.

    The tables do not advance together, so each batch only tells which deals
    changed; their documents are recomputed from the tables as they stand.
    Late rows need no watermark for that reason, and a batch that is replayed
    after a failure replaces the same documents again.
    """

    def process(batch: DataFrame, number: int) -> None:
        live = batch.sparkSession
        tables = read_tables(live, root, [*FEEDING, *STATIC])
        update_deals(live, tables, batch.distinct(), store, current_week, send, f"stream-{number}")
        if send is not None and number:  # a batch is repeated only until the next one begins
            forget_messages(live, store, f"stream-{number - 1}")

    writer = (
        changed_deal_stream(spark, root, files_per_batch)
        .observe("changes", F.count(F.lit(1)).alias("rows"))
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(process)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
