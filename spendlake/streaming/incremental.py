"""Append newly landed export files to the raw table as they arrive.

The loader is a batch rule (newest export wins within one run, keys already
stored stay).  A Structured Streaming file source discovers new ``*.csv``
files -- only their paths are selected, so the binary source does not read
contents -- and ``foreachBatch`` runs the batch load over exactly those files
with append semantics.  A micro-batch is one load run over all files that are
new, however many: a limit per trigger would split a backlog by arrival and let
superseded rows in.  The stream's checkpoint records which files were handled,
and the anti join on the key makes a re-run batch append nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlake.plans.ledger import Ledger
from spendlake.plans.pipeline import load_exports
from spendlake.sources.exports import export_files, read_exports


def _append_batch(raw_path: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        # the file names of the new files; the driver has listed them already
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if paths:
            load_exports(batch.sparkSession, paths, raw_path, append=True)
    return run


def _append_to(ledger: Ledger, stream_name: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if paths:
            spark = batch.sparkSession
            ledger.append(read_exports(spark, paths), run_id=f"{stream_name} {batch_id}",
                          export_files=export_files(spark, paths))
    return run


def start_ledger_load(ledger: Ledger, export_dir: str, checkpoint_location: str, stream_name: str,
                      available_now: bool = True) -> StreamingQuery:
    """Append arriving export files to a stored ledger: raw table, fact, summary, index and audit.

    A micro-batch is one run, known by the stream's name and the batch number: a
    batch that is run again after a failure replaces its own rows and audit."""
    return _start(ledger.spark, export_dir, checkpoint_location, _append_to(ledger, stream_name), available_now)


def start_incremental_load(spark: SparkSession, export_dir: str, raw_path: str, checkpoint_location: str,
                           available_now: bool = True) -> StreamingQuery:
    """Append arriving export files to a raw table."""
    return _start(spark, export_dir, checkpoint_location, _append_batch(raw_path), available_now)


def _start(spark: SparkSession, export_dir: str, checkpoint_location: str, on_batch, available_now: bool) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and
    stops (call ``awaitTermination``)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = (spark.readStream.format("binaryFile").schema(schema)
             .option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "false")
             .load(export_dir)
             .select(F.col("path")))
    writer = (files.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
