"""Session settings, the shared working folder, and staged tables."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: skewed join partitions are split (even if that costs one
# more shuffle), small ones merged, measured-small sides broadcast.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(name="milepost", master=None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in spark.checkpoint.dir.

    A machine-local folder stands in only when nothing is set and Spark runs on
    this machine alone; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="milepost-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/milepost/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Fixes the rows against recomputation (lost executors, sampled range bounds)
    and cuts the lineage. Columnar, so later steps read only what they need. by: columns
    to write in directories of; a filter on them reads only its own.
    """
    path = new_folder(df.sparkSession, label)
    write_parquet(df, path, by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str):
    """`stage` for as long as it is used: the files are deleted when the block ends."""
    path = new_folder(df.sparkSession, label)
    write_parquet(df, path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(df.sparkSession, path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_parquet(df: DataFrame, path: str, by: list[str] = (), mode: str = "errorifexists", open_files: int = 0) -> None:
    """Write rows, zstd-compressed, and delete the shuffle files of this write as soon as it is done.

    Spark itself keeps them until the driver happens to collect garbage, so the shuffles of
    all steps of a job would lie on the disks together. open_files: directories that a task fills at once; only rows
    of more are sorted by directory. For rows that come nearly in that order from files.
    """
    conf, settings = df.sparkSession.conf, {SHUFFLE_CLEANUP: "true"} | ({OPEN_FILES: str(open_files)} if open_files else {})
    before = {name: conf.get(name, None) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        df.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system it belongs to."""
    system, target = _file_system(spark, path)
    return system.delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    system, target = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged. Only once its results are written or collected."""
    remove_folder(spark, f"{shared_folder(spark)}/milepost/{spark.sparkContext.applicationId}")
