"""Load of new document files as they arrive, each document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportarium.plans.bronze import load_batch
from reportarium.sources.documents import stream_texts

# Fixed value: files per batch.
FILES_PER_BATCH = 30


def load_new_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    one_per_file: bool = True,
    key_from_file: bool = False,
    bytes_per_batch: str | None = None,
) -> None:
    """Load all files not seen before, in batches of files or of bytes, and return.

    Batches are named by the query (its id lives in the checkpoint) and their number, so
    a batch repeated after a restart replaces itself, and a new checkpoint on the same
    target starts names of its own and skips what is loaded.
    """
    texts = stream_texts(spark, landing, files_per_batch, one_per_file, bytes_per_batch)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_batch(session, batch, target, f"{query_id}-{number:08d}", key_from_file)

    query = (
        texts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
