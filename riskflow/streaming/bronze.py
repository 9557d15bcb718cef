"""Stream to bronze: decode, keep the raw payload, land each micro-batch once."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import Store

EVENT = "transaction_id string, customer_id string, amount decimal(12,2), channel string, txn_ts timestamp_ntz, op_type string, change_ts timestamp_ntz, is_fraud boolean"


def kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The broker as a source, where the connector is on the class path; earliest offsets, lost data tolerated."""
    return spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", "failOnDataLoss": "false", **options}).load()


def decode(raw: DataFrame, schema: str = EVENT) -> DataFrame:
    """raw (value, partition, offset) -> typed fields beside the payload. Text that doesn't parse gives NULL fields."""
    event = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    out = raw.withColumn("_e", event)
    return out.select("_e.*", F.col("partition").alias("_partition"), F.col("offset").alias("_offset"), F.col("value").cast("string").alias("_raw_payload"))


def retrying(land: Callable[[DataFrame, int], object], retries: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """land, again after base ** attempt seconds when it fails; the last failure is raised."""

    def handler(df: DataFrame, batch: int) -> None:
        for attempt in range(1, retries + 2):
            try:
                land(df, batch)
                return
            except Exception:
                if attempt > retries:
                    raise
                sleep(base**attempt)

    return handler


def ingest(stream: DataFrame, store: Store, table: str, app: str, checkpoint: str, decode_with: Callable[[DataFrame], DataFrame] = decode) -> None:
    """Drains the stream's backlog and stops; a batch that was landed before a lost checkpoint isn't landed again."""

    def land(df: DataFrame, batch: int) -> bool:
        return store.write(table, decode_with(df).withColumn("_ingest_ts", F.current_timestamp()), append=True, app=app, batch=batch)

    query = stream.writeStream.foreachBatch(retrying(land)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
