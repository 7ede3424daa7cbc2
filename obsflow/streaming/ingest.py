"""Files that arrive in a folder, loaded in micro-batches.

Structured Streaming lists new files and remembers in its checkpoint which ones belong to which micro-batch. Each
micro-batch is one batch of the store, named after the checkpoint and its number, so a micro-batch that is replayed after
a failure replaces what its first attempt wrote, and adds nothing when that attempt had been entered.
"""

import hashlib

from pyspark.sql import functions as F

from ..plans.batch import literal_path, run_batch
from ..sources.files import SUPPORTED, any_case

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
FILES_AT_ONCE = 10_000


def arriving_files(spark, folder, files_at_once=FILES_AT_ONCE):
    """Stream of (path): files with a supported extension, also in folders below. Contents are not read."""
    supported = "{" + ",".join(any_case(e) for e in SUPPORTED) + "}"
    files = (
        spark.readStream.schema(FILE_SCHEMA)
        .format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", supported)
        .option("maxFilesPerTrigger", files_at_once)
        .load(folder)
    )
    return files.select(F.col("path"))


def ingest(
    spark, folder, out_dir, checkpoint, default_year, table_provider, domain_provider, trigger=None, files_at_once=FILES_AT_ONCE, **options
):
    """Start loading what arrives in `folder` into the store at `out_dir`; returns the streaming query.

    By default what is there is loaded and the query ends; `trigger` takes the arguments of writeStream.trigger, such as
    {"processingTime": "10 minutes"}. Other options are those of run_batch.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(files, number):
        paths = [literal_path(r.path) for r in files.collect()]  # at most files_at_once
        if paths:
            run_batch(
                files.sparkSession, paths, out_dir, default_year, table_provider, domain_provider,
                batch_name=f"{stream}-{number}", **options,
            )

    return (
        arriving_files(spark, folder, files_at_once)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
