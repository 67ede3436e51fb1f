"""Session helpers: a tuned session, the shared folder, written intermediates."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "specloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()
_local_dirs: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    As ``--py-files`` does; needed where the workers cannot import it otherwise.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        target = Path(tempfile.mkdtemp(prefix="specloom-package-")) / "specloom_package"
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(str(target), "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session on one machine (as on a laptop) may name none; then a local
    folder is set. On a cluster executors would each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_dirs:
            _local_dirs[application] = tempfile.mkdtemp(prefix="specloom-")
            spark.sparkContext.setCheckpointDir(_local_dirs[application])
        folder = _local_dirs[application]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/specloom/{name}-{uuid.uuid4().hex}"


def remove_intermediates(spark: SparkSession) -> None:
    """Delete what ``materialise`` and ``new_path`` left; call it when no frame made from it is in use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/specloom")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: the result survives lost executors, is computed once
    however often it is used, and carries Parquet statistics for the optimizer.
    The files stay until ``remove_intermediates``, or until the folder's owner clears it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
