"""Intermediate tables in shared storage: they cut lineage, survive lost executors, and give the planner real sizes."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


_scratch = {}


def stage(df, path=None):
    """Write once, read back. With file sizes known, a join against a small staged table is broadcast and a large one
    is shuffled, without anyone asserting a size.

    Without a path the table is scratch: it belongs to the session and goes when `release` is called."""
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark, kind="stage"):
    """A new folder in shared storage that goes when `release` is called."""
    path = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def read_or_empty(spark, path, schema):
    """The Parquet table at a path; without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def _folder(spark, path):
    """(file system, path) of a folder in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders_in(spark, path):
    """Names of the folders in a folder; none where it is missing."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(where) if f.isDirectory())


def remove(spark, path):
    files, where = _folder(spark, path)
    files.delete(where, True)


def scratch_mark(spark):
    """How many scratch tables the session has; `release(spark, mark)` removes those made since."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def release(spark, mark=0):
    """Remove the session's scratch tables from `mark` on. Results that read them must have been written by then."""
    made = _scratch.get(spark.sparkContext.applicationId, [])
    for path in made[mark:]:
        remove(spark, path)
    del made[mark:]


def spread_out(df, *keys):
    """One task per shuffle partition for rows that are few but slow to work on; small size alone would merge them.

    Rows are dealt by a hash of the keys: where they are already partitioned by the keys themselves, as after a groupBy,
    the planner would drop the exchange, and the one that is left is merged by size."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *([F.xxhash64(*keys)] if keys else []))


def split_enough(scan):
    """Spread a plain scan that comes in fewer splits than there are cores; larger scans stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
