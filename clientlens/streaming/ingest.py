"""Incremental ingest of arriving files, as an alternative to change windows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clientlens.jobs.audit import AuditLog
from clientlens.operators.incremental import with_ingest_meta
from clientlens.sources.lake import LakeTable


def ingest_files(
    target: LakeTable,
    folder: str,
    file_schema: StructType,
    checkpoint: str,
    source: str,
    log: AuditLog | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Append all files that arrived since the last call as new batches, then stop.

    The stream's checkpoint takes the place of the watermark. A batch that is replayed after a
    failure carries the same batch id and replaces its earlier rows. Readers take the latest
    row per key, as for any other batches. With ``log``, the bronze audit log, each batch is
    recorded, which is how the silver run finds it.

    ``once_within`` is a time such as ``7 days``: rows that arrived already, in the same batch or a file
    of an earlier one, are dropped for so long after they came first. They are remembered by Spark's
    state store under the checkpoint, spread over the shuffle partitions by all columns, and
    forgotten as the watermark of arrival passes; restarts keep it. Other rows of the same key pass.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        # The query id lives in the checkpoint: another stream never has the same one.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"stream-{query_id}-{epoch}"
        now = datetime.now(timezone.utc)
        rows = target.overwrite_partitions(with_ingest_meta(batch, now, source, batch_id))
        if log is not None:
            log.append(batch_id, target.path.rsplit("/", 1)[-1], source, "stream", rows, now)

    arriving = target.spark.readStream.schema(file_schema).parquet(folder)
    if once_within:
        # A batch's time is kept in the checkpoint, so a replay sees the same one, and none is late.
        timed = arriving.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", once_within)
        arriving = timed.dropDuplicatesWithinWatermark(file_schema.names).drop("_arrived")
    return (
        arriving.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append)
        .start()
    )
