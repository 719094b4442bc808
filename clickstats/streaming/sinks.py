"""Starting streaming queries (S4, S5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_stream(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
                 mode: str = "append", trigger: dict | None = None, query_name: str | None = None,
                 for_each_batch: Callable[[DataFrame, int], None] | None = None,
                 options: dict | None = None, partition_by: list[str] | str | None = None) -> StreamingQuery:
    """Start ``df`` as a streaming query.

    ``checkpoint`` is required: it holds the source offsets and the operator
    state, so a restarted query (or one whose executors were lost) resumes
    exactly where it stopped. Put it in the shared checkpoint folder.
    ``sink``: ``parquet`` (needs ``path``), ``console``, ``memory`` (needs
    ``query_name``) or ``foreachBatch`` (needs ``for_each_batch``).
    ``partition_by`` splits a parquet sink into folders by those columns.

    A parquet folder belongs to one checkpoint: its log names the batches that
    are in it, and a new checkpoint would have its first batches taken for
    those. Such a start raises.
    ``trigger`` is passed to ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "5 seconds"}``.
    """
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint location")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    if sink == "foreachBatch":
        if for_each_batch is None:
            raise ValueError("foreachBatch needs a function")
        return w.foreachBatch(for_each_batch).start()
    if sink == "parquet":
        if not path:
            raise ValueError("parquet sink needs a path")
        if _exists(df.sparkSession, f"{path}/_spark_metadata") and not _exists(df.sparkSession, f"{checkpoint}/offsets"):
            raise ValueError(f"{path} holds the results of another checkpoint; {checkpoint} is new")
        if partition_by:
            w = w.partitionBy(partition_by)
        return w.format("parquet").start(path)
    return w.format(sink).start()
