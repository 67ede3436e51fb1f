"""New library files to the library table, as they arrive.

The steps are those of a batch run; Structured Streaming only remembers which
files were taken in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from specloom.plans.library import prepare_library
from specloom.sources.store import latest_per_id, new_rows


def append_new_spectra(spark: SparkSession, batch: DataFrame, library_path: str, order_by: list[str]) -> None:
    """Append a batch's unknown spectra; safe to repeat after a failure."""
    fresh = latest_per_id(batch, order_by)
    store = spark.read.schema(batch.schema).option("ignoreMissingFiles", "true").parquet(library_path)
    new_rows(fresh, store).write.mode("append").partitionBy("ion_mode").parquet(library_path)


def ingest_raw_stream(
    spark: SparkSession, raw_stream: DataFrame, library_path: str, checkpoint_path: str
) -> StreamingQuery:
    """Clean raw records of a stream and add the new ones to the library."""
    empty = prepare_library(spark.createDataFrame([], raw_stream.schema))
    empty.limit(0).write.mode("append").partitionBy("ion_mode").parquet(library_path)

    def add(batch: DataFrame, _: int) -> None:
        append_new_spectra(batch.sparkSession, prepare_library(batch), library_path, ["precursor_mz"])

    return (
        raw_stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )

