"""Streaming source, cleaning and scoring of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from playlab.functions.columns import KEY
from playlab.operators.clean import blank_to, clean
from playlab.sources.plays import PLAYS_SCHEMA


def read_plays_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files under ``path`` as a stream (the schema is fixed, not inferred)."""
    reader = spark.readStream.schema(PLAYS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def clean_stream(stream: DataFrame, all_columns: bool = True) -> DataFrame:
    """Fourth downs, NULL rule, no kneels, blank surface -> 'Undefined': stateless."""
    return blank_to(clean(stream, all_columns=all_columns), "surface")


def score_stream(model, stream: DataFrame, columns=(KEY, "play_type", "play_type_idx", "prediction")) -> DataFrame:
    """A fitted pipeline applied to a stream (every stage is a per-row map)."""
    return model.transform(stream).select(*columns)


def start_scoring(scored: DataFrame, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append predictions to parquet at ``sink``.

    ``checkpoint`` keeps the progress: a query restarted with the same folder goes
    on where it stopped.
    """
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
