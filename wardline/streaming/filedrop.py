"""File-drop ingestion with Structured Streaming.

New CSV extracts dropped into a folder are picked up incrementally with
``readStream`` and handed, batch by batch, to the same DataFrame builders used
for batch loads (``build_events``, ``build_measurements`` ...) through
``foreachBatch``.  ``trigger(availableNow=True)`` processes what is there and
stops, so a scheduler can run it like a batch job while the checkpoint
remembers which files were already loaded.  Each micro-batch overwrites its own
``batch_id`` folder of the sink, so a batch that is replayed after a failure
replaces what it wrote before: no row is loaded twice.

A stream has one fixed schema: point one stream at files sharing a header.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.functions.labels import NULL_TOKENS
from wardline.sources.files import CORRUPT_COL, clean_rows, file_name
from wardline.sources.model import FILE_COL


def csv_stream(spark: SparkSession, directory: str, header: list[str], id_column: str,
               pattern: str = "*.[cC][sS][vV]", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over CSV files in ``directory`` sharing ``header``.

    Cleaned as the batch scan is (``clean_rows``): null tokens, canonical id,
    blank lines, short and long rows; quoted line breaks are honoured, and a
    file whose header differs, also in order, fails the batch.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT_COL]])
    reader = (spark.readStream.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT_COL)
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(directory).withColumn(FILE_COL, file_name())
    return clean_rows(raw, header, id_column, NULL_TOKENS)


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_path: str,
           checkpoint: str, fmt: str = "parquet", available_now: bool = True,
           query_name: str | None = None) -> StreamingQuery:
    """Apply a batch ``transform`` to each micro-batch and write the result to ``sink_path/batch_id=<n>``.

    ``checkpoint`` must be on shared storage, and belongs to one sink: it
    records processed files, and the numbers of the batches.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").format(fmt).save(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
