"""Line sources: text files, Kafka topics and sockets, batch or streaming.

Every reader returns a DataFrame with one string column ``value`` holding a
raw line, which the ingest operators parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Read text files as lines (``value string``).

    Batch reads split large files across tasks; a streaming read picks up new
    files as they land, ``max_files_per_trigger`` of them per micro-batch.
    """
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_kafka_lines(spark: SparkSession, servers: str, topic: str = "hot",
                     starting_offsets: str = "latest", streaming: bool = True,
                     options: dict | None = None) -> DataFrame:
    """Consume a Kafka topic; returns the source's rows (decode with ``decode_kafka``).

    Consumer-group offsets are replaced by the offsets Spark keeps in the
    query's checkpoint, so a restarted query resumes where it stopped.
    Needs the spark-sql-kafka connector on the classpath.
    """
    reader = spark.readStream if streaming else spark.read
    reader = (reader.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    if streaming:
        reader = reader.option("startingOffsets", starting_offsets)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def decode_kafka(rows: DataFrame) -> DataFrame:
    """Kafka source rows -> ``value string`` lines (the record value, UTF-8).

    Keeps the topic coordinates next to the line so rejected lines can be
    traced back to their offset.
    """
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic"), F.col("partition"), F.col("offset"),
    )


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (Spark documents this source for testing only)."""
    return (spark.readStream.format("socket")
            .option("host", host).option("port", str(port)).load())
