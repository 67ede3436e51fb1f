"""Parquet datasets: partitioned writes, many paths, versions, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("ion_mode",)) -> None:
    """Write a dataset whose partition columns prune later reads."""
    df.write.partitionBy(*partition_by).parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_many_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several directories of chunk files as one set, each row with its file."""
    return spark.read.parquet(*paths).withColumn("source_path", F.col("_metadata.file_path"))


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _file_system(spark, path)
    return fs.exists(jpath)


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last version that was written to its end."""
    root, fs = _file_system(spark, path)
    if not fs.exists(root):
        return None
    done = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        marker, _ = _file_system(spark, f"{path}/{name}/_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(marker):
            done.append(int(name[1:]))
    return max(done, default=None)


def version_path(path: str, version: int) -> str:
    return f"{path}/v{version:06d}"


def write_version(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write the next version of a table; readers see it only when it is complete.

    The version being read is never overwritten, so a new one may be computed
    from it, and a job that dies leaves the current one in place.
    """
    current = latest_version(df.sparkSession, path)
    version = 0 if current is None else current + 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(version_path(path, version))
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current, or a given, version of a table."""
    if version is None:
        version = latest_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(version_path(path, version))


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Overwrite only the partitions present in ``df``; others stay untouched."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _partition_columns(fs, root) -> list[str]:
    """The partition columns of a table, in the order of its folders; emptied folders tell none."""
    deepest: list[str] = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            columns = [name.split("=")[0], *_partition_columns(fs, status.getPath())]
            deepest = max(deepest, columns, key=len)
    return deepest


def drop_partition(spark: SparkSession, path: str, **values: str) -> None:
    """Remove one partition's files; nothing happens when it does not exist.

    A value is needed for every partition column, in any order: fewer would
    remove more than one partition.
    """
    root, fs = _file_system(spark, path)
    if not fs.exists(root):
        return
    columns = _partition_columns(fs, root)
    if set(columns) < set(values):  # all such partitions are gone
        return
    if set(columns) != set(values):
        raise ValueError(f"{path} is partitioned by {columns}; values were given for {sorted(values)}")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = "/".join([path, *[f"{name}={escape(str(values[name]))}" for name in columns]])
    jpath, fs = _file_system(spark, folder)
    fs.delete(jpath, True)
