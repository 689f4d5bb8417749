"""Drop-folder append: files landing in a folder are appended to a source's tables.

A Structured Streaming query lists new files with the ``binaryFile`` source (only
paths and sizes are selected, so contents are not read by the stream) and hands each
micro-batch to ``foreachBatch``, which runs the normal schema-evolving append for every
new file in path order. Exactly once: the streaming checkpoint remembers which files were seen, and every file's rows go
into a batch named by checkpoint, micro-batch and place in it. A micro-batch replayed after a failure finds the
batches that were committed in the commit log and skips them; one that was written but not committed is replaced.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reportlake.plans.lake import Lake
from reportlake.session import scratch_dir

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def batch_name(checkpoint: str, epoch: int, place: int) -> str:
    """The batch that holds a file's rows: the same on every replay of its micro-batch."""
    return f"stream-{xxhash.xxh3_64_hexdigest(checkpoint.encode())}-{epoch}-{place}"


def append_stream(lake: Lake, source_id: str, folder: str, checkpoint: str | None = None,
                  glob: str = "*.{csv,txt,xls,xlsx,CSV,TXT,XLS,XLSX}", available_now: bool = True,
                  reports: list | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Start the drop-folder append. With ``available_now`` the query processes what is in
    the folder and stops; otherwise it keeps watching. Append reports are gathered into
    ``reports`` when a list is given."""
    spark = lake.spark
    ckpt = checkpoint or scratch_dir(spark, f"stream-{source_id}")
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "length"))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").orderBy("path").collect()]  # at most files_per_batch names
        for place, path in enumerate(paths):
            rep = lake.append(source_id, path, batch=batch_name(ckpt, epoch_id, place))
            if reports is not None:
                reports.append(rep.withColumn("file", F.lit(path)).collect())

    writer = files.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
