"""Session helpers: local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "touchline") -> SparkSession:
    """Session for laptops, tests and the benchmark. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the wide projections here profit from; a value the user set stays.

    A generated method above 8000 bytes is never compiled by the JVM. With this
    limit Spark falls back to projections split into small methods, which are.
    """
    wanted = {"spark.sql.codegen.hugeMethodLimit": "8000"}
    for key, value in wanted.items():
        if spark.conf.get(key) in (None, "65535"):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the folder named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, which goes with the
    process: on a cluster the folder must be one that every executor can reach.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="touchline-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def spread(df: DataFrame, tasks_a_core: int = 4) -> DataFrame:
    """``df`` dealt evenly to ``tasks_a_core`` tasks for each core of the cluster, at every size.

    For work that is heavy by row (parsing) behind an input that comes in few pieces: Spark splits
    files by size, and Parquet only at row groups.
    """
    return df.repartition(tasks_a_core * df.sparkSession.sparkContext.defaultParallelism)


def write_table(df: DataFrame, partition_by: Sequence[str] = (), more: Sequence[DataFrame] = (), codec: str | None = None) -> DataFrame:
    """``materialise`` with a folder for each value of ``partition_by``.

    The frames of ``more`` have the columns of ``df`` and are written behind it one after the other, so that the shuffles of one are gone before the next.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    # The shuffles of this write are of no use once it is done; by default they lie on disk until the driver's next collection of garbage.
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        for part in (df, *more):
            part.write.mode("append").options(**{"compression": codec} if codec else {}).partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before) if before is not None else spark.conf.unset(_FREE_SHUFFLES)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it from there.

    Used where one frame feeds several passes (model search, skew statistics).
    Unlike ``persist`` the copy survives the loss of an executor, and unlike an RDD
    checkpoint it is read by column and its size is known to the planner. ``codec`` "zstd"
    is for wide tables that stay long.
    """
    return write_table(df, codec=codec)


# Tables written by ``materialise`` in this driver and not dropped yet.
_written: list[str] = []
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` has written; frames that read them are dead afterwards."""
    for table in tables:
        files = table.inputFiles()
        for path in [p for p in _written if any(p.split(":", 1)[-1] + "/" in f for f in files)]:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
            _written.remove(path)


def drop_materialised(spark: SparkSession) -> int:
    """Delete the tables ``materialise`` has written; frames that read them are dead afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _written:
        place = jvm.org.apache.hadoop.fs.Path(_written.pop())
        dropped += bool(place.getFileSystem(conf).delete(place, True))
    return dropped
