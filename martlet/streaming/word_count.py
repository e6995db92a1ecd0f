"""Word frequencies maintained incrementally over an append-only file source.

Plan: file stream -> Generate(explode(split(lower))) -> NOT IN stop words ->
stateful count per word (state = one row per distinct word, i.e. the
vocabulary, never the texts). Each micro-batch republishes the complete counts
as a new table version through the staged publish, so readers always see a
whole epoch, and a retried epoch publishes the same result again (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martlet.operators import text
from martlet.sources import tables


def word_counts_of(stream: DataFrame, text_col: str, stop_words=None) -> DataFrame:
    tokens = text.tokenize(stream, text_col)
    tokens = text.remove_stop_words(tokens, stop_words=stop_words)
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def start_word_count(spark: SparkSession, source_path: str, schema: T.StructType, text_col: str,
                     table_name: str, table_base: str, checkpoint: str, fmt: str = "parquet",
                     available_now: bool = True, processing_time: str | None = None,
                     max_files_per_trigger: int | None = None,
                     base_path: str | None = None, retain_seconds: float = 3600.0) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what exists and stops.

    ``source_path`` is normally a directory new files land in; a single file
    (or glob) also works when ``base_path`` names its directory. Counts that an epoch
    replaces stay for ``retain_seconds``, for readers that began before.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    counts = word_counts_of(reader.load(source_path), text_col)

    def publish_epoch(batch: DataFrame, epoch_id: int) -> None:
        tables.publish(batch.sparkSession, batch, table_name, table_base, retain_seconds=retain_seconds)

    writer = (counts.writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(publish_epoch))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
