"""Session defaults for local runs; a cluster brings its own session."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus="*", shuffle_partitions=8, memory="8g"):
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("obsflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        # HotSpot leaves methods over 8,000 bytes of bytecode uncompiled; let Spark split such stages instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark):
    """Use the shared folder the cluster names; make one up only where none is named (local runs)."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return spark.conf.get("spark.checkpoint.dir")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = os.path.join(tempfile.mkdtemp(prefix="obsflow-"), "checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
