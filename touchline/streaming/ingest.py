"""New files become parts of the units of a partitioned table, each file once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.sources.commits import CommitTable
from touchline.sources.tables import DELIVERY, append_once


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV files as they arrive, under an explicit schema; ``_delivery`` tells the file of each row."""
    files = (
        spark.readStream.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .csv(folder)
    )
    return files.withColumn(DELIVERY, F.md5(F.col("_metadata.file_path").cast("string")))


def ingest(stream: DataFrame, sink: str, done_path: str, checkpoint: str, keys: Sequence[str]) -> StreamingQuery:
    """Write what has arrived and stop.

    The stream's checkpoint remembers the files it has seen; ``append_once`` overwrites
    the folders of a file that comes again, so neither a restart nor a repeated delivery
    writes a row twice, and rows of a unit that come in a later file are kept.
    """

    def write(batch: DataFrame, _: int) -> None:
        kept = batch.persist()
        try:
            append_once(kept, sink, done_path, keys)
        finally:
            kept.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_commits(stream: DataFrame, table: CommitTable, checkpoint: str) -> StreamingQuery:
    """Commit what has arrived to ``table`` and stop.

    A batch is one commit of all its files. A batch that is run again, because the job died before or
    after its commit, replaces what its files brought, and so does a file that is delivered again.
    """

    def write(batch: DataFrame, _: int) -> None:
        table.append(batch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
