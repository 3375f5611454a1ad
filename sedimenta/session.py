"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
JOB_THREADS = 8

# The engine relies on UTC timestamps; the rest are Spark's own knobs, listed so that a
# deployment can see them in one place. `spark.sql.shuffle.partitions` is left to the
# cluster: AQE coalesces small partitions, and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_dirs: dict[str, str] = {}


def build_session(app: str = "sedimenta", master: str | None = None, **conf: str) -> SparkSession:
    """Session with `SETTINGS`; `conf` keys use `__` for the dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: `spark.checkpoint.dir` of the session.

    Only a local session without that setting falls back to a temporary folder; on a
    cluster a machine-local folder would not be seen by the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sedimenta-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/sedimenta/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def clear_stages(spark: SparkSession) -> None:
    """Delete the intermediate tables that this application wrote; call it when nothing reads
    them any more."""
    files, target = file_system(spark, f"{shared_dir(spark)}/sedimenta/{spark.sparkContext.applicationId}")
    files.delete(target, True)


def together(tasks: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs from several driver threads, so that the executors are shared by
    all of them instead of idling at the tail of each."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, min(len(tasks), JOB_THREADS))) as pool:
        futures = {name: pool.submit(inherit(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once and read it back: cuts the lineage, survives lost executors.

    The schema is handed to the reader, so no job is spent on inferring it.
    """
    return stage_counted(df, label)[0]


def stage_counted(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """`stage`, with the number of rows, which the write itself counts."""
    path = new_path(df.sparkSession, label)
    rows = write_counted(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def write_counted(df: DataFrame, path: str) -> int:
    """Write Parquet; the rows are counted on the way instead of by a second job.

    Only the tasks of the write itself count, each once, also if one is run again.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get["rows"]
