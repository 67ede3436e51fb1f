"""Spectra laid out by precursor m/z, with a small index of each file's bounds.

Files hold neighbouring m/z of one ion mode (or other columns), sorted, and the index tells which
files a window can touch. So a narrow search opens a few files, whatever the
library's size, and within these row groups are pruned by the pushed filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.operators.candidates import query_buckets

MZ = "precursor_mz"


def write_clustered(spectra: DataFrame, path: str, by: tuple[str, ...] = ("ion_mode",), n_files: int | None = None) -> None:
    """Write ``spectra`` in ranges of (by, m/z), and the index of the files' bounds.

    ``n_files`` is about a table's size by 128 MB; without it there are as many files as
    shuffle partitions. Ranges are cut by sampling, so a crowded m/z has more files.
    """
    spark = spectra.sparkSession
    # Behind the m/z the id, so that one m/z, however crowded, can be cut.
    order = [*by, MZ, "spectrum_id"]
    ranged = spectra.repartitionByRange(n_files, *order) if n_files else spectra.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(f"{path}/data")
    written = spark.read.schema(spectra.schema).parquet(f"{path}/data")
    bounds = written.withColumn("file", F.element_at(F.split("_metadata.file_path", "/"), -1)).groupBy("file", *by)
    bounds = bounds.agg(F.min(MZ).alias("low"), F.max(MZ).alias("high"), F.count("*").alias("n_rows"))
    bounds.coalesce(1).write.parquet(f"{path}/index")


def file_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(file, by, low, high, n_rows): one row for each file and value of ``by`` in it."""
    return spark.read.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str, touched: DataFrame) -> DataFrame:
    """The rows of some files."""
    names = sorted(r.file for r in touched.select("file").distinct().collect())
    whole = spark.read.parquet(f"{path}/data")
    if not names:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*[f"{path}/data/{n}" for n in names])


def clustered_range(spark: SparkSession, path: str, min_mz: float | None = None, max_mz: float | None = None, **by) -> DataFrame:
    """The rows with ``min_mz <= precursor_mz <= max_mz`` and the given values, from the files that can hold some.

    None means no bound; rows without an m/z are in no window.
    """
    index = file_bounds(spark, path)
    inside = [F.col(k) == v for k, v in by.items()]
    inside_file = list(inside)
    if min_mz is not None:
        inside.append(F.col(MZ) >= min_mz)
        inside_file.append(F.col("high") >= min_mz)
    if max_mz is not None:
        inside.append(F.col(MZ) <= max_mz)
        inside_file.append(F.col("low") <= max_mz)
    for condition in inside_file:
        index = index.filter(condition)
    rows = _files(spark, path, index)
    for condition in inside:
        rows = rows.filter(condition)
    return rows


def clustered_near(
    spark: SparkSession, path: str, queries: DataFrame, mz_range: float = 1.0, by: tuple[str, ...] = ("ion_mode",)
) -> DataFrame:
    """The rows of all files that a window of ``queries`` (query_mz, by) touches: the references of a search.

    Windows and files meet in buckets of m/z, of which there are few; no query is collected.
    """
    width = mz_range or 1.0
    windows = query_buckets(queries.select(*by, "query_mz"), "query_mz", mz_range).select(*by, "bucket").distinct()
    bucket = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("bigint")
    index = file_bounds(spark, path).filter("low is not null")
    reach = index.withColumn("bucket", F.explode(F.sequence(bucket("low"), bucket("high"))))
    return _files(spark, path, reach.join(windows, [*by, "bucket"], "left_semi"))
