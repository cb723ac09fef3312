"""Change envelopes on a topic or in files: one JSON text per message.

``fmt`` is ``kafka`` on a cluster (its connector jar must be on the classpath)
or any file format with one ``value`` text column; both give a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Where a message came from: topic, partition and offset, or its file.
POSITION = "__position"

_KAFKA_BATCH = {"startingOffsets": "earliest", "endingOffsets": "latest"}
_KAFKA_STREAM = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}


def _with_position(frame: DataFrame, fmt: str) -> DataFrame:
    if fmt == "kafka":
        place = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    else:
        place = F.col("_metadata.file_path")
    return frame.select(F.col("value").cast("string").alias("value"), place.alias(POSITION))


def envelope_stream(
    spark: SparkSession, fmt: str, path: str | None = None, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Unbounded messages with their source position, from the earliest one on.

    ``per_trigger`` bounds the messages (files, with a file format) of a
    micro-batch; without it a batch takes all there is.
    """
    reader = spark.readStream.format(fmt)
    defaults = dict(_KAFKA_STREAM) if fmt == "kafka" else {}
    if per_trigger is not None:
        defaults["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(per_trigger)
    for key, value in {**defaults, **options}.items():
        reader = reader.option(key, value)
    if fmt not in ("kafka", "text"):
        reader = reader.schema("value string")
    frame = reader.load(path) if path else reader.load()
    return _with_position(frame, fmt)


def envelope_batch(
    spark: SparkSession, fmt: str, path: str | None = None, **options: str
) -> DataFrame:
    """All messages that exist now."""
    reader = spark.read.format(fmt)
    for key, value in {**(_KAFKA_BATCH if fmt == "kafka" else {}), **options}.items():
        reader = reader.option(key, value)
    frame = reader.load(path) if path else reader.load()
    return frame.select(F.col("value").cast("string").alias("value"))


def as_messages(envelopes: DataFrame) -> DataFrame:
    """Envelope columns packed into one JSON ``value``; NULL fields are left out."""
    return envelopes.select(F.to_json(F.struct("*")).alias("value"))


def publish_envelopes(
    envelopes: DataFrame,
    fmt: str,
    path: str | None = None,
    checkpoint: str | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Append the envelopes to a topic or a folder, as a batch or as a stream."""
    messages = as_messages(envelopes)
    if envelopes.isStreaming:
        writer = messages.writeStream.format(fmt).outputMode("append")
        writer = writer.option("checkpointLocation", checkpoint)
        for key, value in options.items():
            writer = writer.option(key, value)
        return writer.start(path) if path else writer.start()
    batch = messages.write.format(fmt).mode("append")
    for key, value in options.items():
        batch = batch.option(key, value)
    batch.save(path) if path else batch.save()
    return None
