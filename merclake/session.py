"""Session settings and the shared folder of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Partitions a shuffle of tables begins with. AQE only joins partitions, so with few to begin with a task's share is the
#: input over a fixed number; with these it is bounded by the advisory size. Up to 200 a map task needs no sort for them.
INITIAL, INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 200
#: Settings every job of this library expects. Sizes that depend on the cluster
#: (shuffle partitions, executor memory) are left to the cluster's own defaults;
#: AQE coalesces small partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where a grouping on the same key follows and needs a new shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # merge sessions inside each map task before the shuffle
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the library's SQL settings on a session that somebody else made."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("merclake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders made by this process, and the local root where a test session names none.
_MADE: list[str] = []
_LOCAL: list[tempfile.TemporaryDirectory] = []
#: Spark's setting to drop the shuffle files of a query as soon as it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only where nothing is set and Spark itself runs
    in one local process a folder of that process takes its place; it goes when the process ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="merclake-"))
    return _LOCAL[0].name


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder."""
    path = f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def forget_shared(spark: SparkSession) -> None:
    """Delete the folders this process has made, when no frame that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    for path in _MADE:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _MADE.clear()


def store(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame that later steps read again to the shared folder and read it back. It outlives lost
    executors, cuts the lineage, and keeps column pruning and statistics. Steps that read one value of a column
    each say so by ``partition_by``."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")  # the shuffles of this write serve nothing else
    try:
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    finally:
        spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once that several later steps read."""
    return store(df, "rows")
