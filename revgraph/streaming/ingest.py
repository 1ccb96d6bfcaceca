"""Incremental ingest of dump files with Structured Streaming (S2 + S4).

The original job walks the files of its input folder one after the other and
skips every (year, page) already written. Here the folder is a file stream:
Spark tracks which files were processed in the stream's checkpoint, each
micro-batch runs the batch plan (parse -> latest per year -> annotate) and
adds only pages not yet in the store. A micro-batch is stored under the names
of its stream and number and committed last: retried, it overwrites what it had
begun, and once committed it does nothing, so neither pages nor rejected
revisions are lost or doubled by a restart.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from revgraph.plans.graphs import ingest_chunks
from revgraph.session import scratch_path
from revgraph.sources.dump import numbered, stream_chunks


def stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The stream's own id, which Spark keeps in its checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first()["value"])["id"]


def ingest_stream(
    spark: SparkSession,
    dump_path: str,
    store_path: str,
    checkpoint_path: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest stream; with ``available_now`` it stops when caught up.

    ``checkpoint_path`` defaults to a new folder under the shared
    ``spark.checkpoint.dir``; pass the same path again to resume. A batch
    takes ``max_files_per_trigger`` files; without it the first one is the
    whole backlog. Rejected revisions go where the batch job puts them.
    """
    checkpoint_path = checkpoint_path or scratch_path(spark, "ingest-stream")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint_path)
        ingest_chunks(numbered(batch), store_path, fmt, batch=f"stream-{stream}-{batch_id}")

    writer = stream_chunks(spark, dump_path, max_files_per_trigger).writeStream.foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint_path)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
