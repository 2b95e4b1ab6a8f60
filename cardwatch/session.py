"""Session settings and the shared working folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the operators are written for. AQE coalesces small partitions, splits skewed join
#: partitions and switches to a broadcast join only after it has measured the side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cardwatch")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a missing setting is
    an error, because a machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="cardwatch-")
        folder = _LOCAL_FOLDERS[context.applicationId]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Cut the lineage of a DataFrame that several branches of a plan read."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def saved(df, name: str = "table", options: dict = {}):
    """Write a table to the shared folder and read it back.

    For rows an iterative fit reads many times: every task then carries the short plan of a file
    scan instead of the whole lineage, and a lost executor costs a re-read, not a re-run.
    ``options`` are those of the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def discard(df) -> None:
    """Remove a table that ``saved`` returned, once nothing will read it again."""
    path = getattr(df, "_saved_path", None)
    if path:
        store, target = _file_system(df.sparkSession, path)
        store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _file_system(spark, path)
    return store.exists(target)


def without_summary(model):
    """The model, or a pipeline's stages, without the training summary, which holds the session.

    Spark sends a classifier whole to the tasks. A summary carries the driver's session along, which
    cannot be written any more once a query of the session was observed (``Observation``).
    """
    stages = getattr(model, "stages", None)
    if stages is not None:
        return type(model)([without_summary(s) for s in stages])
    if not getattr(model, "hasSummary", False):
        return model
    bare = model.copy()
    bare._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return bare
