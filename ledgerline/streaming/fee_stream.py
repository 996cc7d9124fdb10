"""The fee-transaction layer, kept up to date as transaction files arrive.

The layer is a filter plus a lookup of the user, so it streams without any
state: new transaction files are read as a stream, filtered to completed fee
transactions and enriched by a stream-static left join with the users table
(the same function as the batch layer). The sink writes Parquet with a
checkpoint in the shared checkpoint folder, so a restarted or re-tried query
continues exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.plans.neobank import fee_transactions_enriched
from ledgerline.session import checkpoint_dir


def fee_transactions_stream(spark: SparkSession, source_path: str, users: DataFrame,
                            schema: StructType | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of enriched fee transactions over Parquet files in ``source_path``."""
    if schema is None:
        schema = spark.read.parquet(source_path).schema
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return fee_transactions_enriched(reader.load(source_path), users)


def start_layer_sink(stream: DataFrame, out_path: str, name: str, checkpoint: str | None = None,
                     available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append the stream to Parquet at ``out_path`` (checkpointed; exactly-once file sink)."""
    spark = stream.sparkSession
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", out_path).option("checkpointLocation", location).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
