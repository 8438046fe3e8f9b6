"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Results depend on these: `created_utc` is read as UTC and arithmetic errors are raised, not hidden.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "forumlens", conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the settings results depend on; sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_conf(spark: SparkSession) -> SparkSession:
    """Set the required settings on a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in `spark.checkpoint.dir`. Only a local session that has none gets a
    temporary folder; a cluster without the setting is an error, since executors cannot share one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="forumlens-ckpt-"))
    return context.getCheckpointDir()


_STAGED: list[str] = []


def stage(df: DataFrame, vectors: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where one expensive input feeds several model fits: a lost executor then costs a re-read of
    a file split instead of a re-run of the text pipeline. The table is read with a bare schema: the
    attributes that ML columns carry name every term of a vocabulary, and would travel with the scan in
    every job of every solver step. Columns in `vectors` hold the struct of a vector and are read as one.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    kinds = [(f.name, VectorUDT() if f.name in vectors else f.dataType) for f in df.schema.fields]
    bare = T.StructType([T.StructField(name, kind) for name, kind in kinds])
    return df.sparkSession.read.schema(bare).parquet(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below a path, from one content summary of the store."""
    store, place = _hadoop_path(spark, path)
    return store.getContentSummary(place).getLength()


def table_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Stored bytes and time of the last change of a table's file or folder."""
    store, place = _hadoop_path(spark, path)
    return store.getContentSummary(place).getLength(), store.getFileStatus(place).getModificationTime()


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables this process has staged; for the end of a job, once its results are written."""
    while _STAGED:
        store, path = _hadoop_path(spark, _STAGED.pop())
        store.delete(path, True)


def _hadoop_path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
