"""Cluster-side concerns: size checks before a broadcast, caching, cut lineage."""

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows a side may have to be broadcast.  Only narrow rows (ids, numbers, file-name
#: fields) are ever offered, so this stays in the tens of megabytes.
BROADCAST_ROWS = 200_000

#: Session settings worth having on a cluster; all are plain Spark options.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Settings for jobs that move whole images through Python: a decoded image can be
#: 100 MB, so an Arrow batch must hold few of them.
IMAGE_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    "spark.sql.execution.arrow.maxBytesPerBatch": "128m",
}


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than that many."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it is small, unchanged otherwise."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def cache_stage(df: DataFrame, replicas: int = 1) -> DataFrame:
    """Keep a stage for reuse, spilling to disk; two replicas survive a lost executor
    without recomputing."""
    level = StorageLevel.MEMORY_AND_DISK_2 if replicas > 1 else StorageLevel.MEMORY_AND_DISK
    return df.persist(level)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from the session's ``spark.checkpoint.dir``.

    A local session that names none uses one under the working folder; any other must name one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(os.getcwd(), "spark-warehouse", "stages")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written copy."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark can write one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Stages:
    """Intermediate results with an owner: what is kept here is let go when the block ends.

    ``keep`` caches; ``write`` writes Parquet below the shared folder, which also survives lost
    executors and ends the plan before it.  Results that still have to be read are written out, or
    moved to an outer owner by ``write``, before the block ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.kept: list[DataFrame] = []
        self.folders: list[str] = []

    def __enter__(self) -> "Stages":
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(cache_stage(df))
        return self.kept[-1]

    def write(self, df: DataFrame, name: str = "stage") -> DataFrame:
        folder = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.folders.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def release(self) -> None:
        while self.kept:
            self.kept.pop().unpersist()
        while self.folders:
            delete_folder(self.spark, self.folders.pop())


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input that is read as fewer splits than there are cores.

    A large input has more splits than cores and is returned as it is, with no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def peek(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def row_count(df: DataFrame) -> int:
    return df.count()


def save(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a result as Parquet; results leave the cluster through storage, not the driver."""
    df.write.mode(mode).parquet(path)


def session(
    app: str = "tessella", master: str | None = None, images: bool = False, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above, then ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (CLUSTER_CONF | (IMAGE_CONF if images else {}) | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
