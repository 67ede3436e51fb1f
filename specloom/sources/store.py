"""The keyed library: insert-or-replace, incremental caching, multi-get, delete.

Tables are ordinary DataFrames with a ``spectrum_id``; every function returns
the new content, to be written with ``datasets.write_version`` or, for pure
additions, appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from specloom.schema import check_ion_mode
from specloom.session import materialise
from specloom.sources.datasets import drop_partition


def latest_per_id(batch: DataFrame, order_by: list[str], key: str = "spectrum_id") -> DataFrame:
    """The last row of each id; pre-aggregated, so an id written very often is no hot key."""
    last = F.max_by(F.struct(*[c for c in batch.columns if c != key]), F.struct(*order_by))
    return batch.groupBy(key).agg(last.alias("_row")).select(key, "_row.*").select(*batch.columns)


def upsert_spectra(
    store: DataFrame, batch: DataFrame, order_by: list[str], key: str = "spectrum_id"
) -> DataFrame:
    """``store`` with the batch's rows put in place; the last write of an id wins."""
    fresh = latest_per_id(batch, order_by, key).select(*store.columns)
    return store.join(fresh.select(key), key, "left_anti").select(*store.columns).unionByName(fresh)


def _ids(df: DataFrame, key: str = "spectrum_id") -> DataFrame:
    """Each id once: repeats are removed before the shuffle that a join needs anyway."""
    return df.select(key).distinct()


def new_rows(batch: DataFrame, store: DataFrame, key: str = "spectrum_id") -> DataFrame:
    """One row of the batch for each id that is not stored: what an append has to write.

    Of rows that repeat an id the one with the smallest hash counts; where the
    order of writing matters, apply ``latest_per_id`` first.
    """
    fresh = batch.join(_ids(store, key), key, "left_anti").select(*batch.columns)
    return latest_per_id(fresh.withColumn("_order", smallest_hash(fresh)), ["_order"], key).drop("_order")


def smallest_hash(df: DataFrame) -> Column:
    """An order by which the last of equal ids is the one with the smallest hash."""
    return -F.xxhash64(*[F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in df.dtypes])


def cache_new_spectra(
    batch: DataFrame, store: DataFrame, key: str = "spectrum_id"
) -> tuple[DataFrame, DataFrame]:
    """(rows to append, every id of the batch, known ones included)."""
    return new_rows(batch, store, key), batch.select(key)


def stored_ids(store: DataFrame) -> DataFrame:
    return _ids(store)


def existing_ids(ids: DataFrame, store: DataFrame) -> DataFrame:
    """The given ids that are stored, each once."""
    return _ids(ids).join(_ids(store), "spectrum_id", "left_semi")


def missing_ids(ids: DataFrame, store: DataFrame) -> DataFrame:
    """The given ids that are not stored; repeated ids stay repeated."""
    return ids.select("spectrum_id").join(_ids(store), "spectrum_id", "left_anti")


def _fetch(table: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows of the given ids: all for None, none for an empty set; unknown ids are skipped."""
    if ids is None:
        return table
    return table.join(_ids(ids), "spectrum_id", "left_semi").select(*table.columns)


def fetch_spectra(store: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    return _fetch(store, ids)


def fetch_embeddings(
    embeddings: DataFrame, project: str, ion_mode: str, ids: DataFrame | None = None
) -> DataFrame:
    part = embeddings.filter(
        (F.col("project") == project) & (F.col("ion_mode") == check_ion_mode(ion_mode))
    )
    return _fetch(part, ids)


def fetch_binned(binned: DataFrame, ion_mode: str, ids: DataFrame | None = None) -> DataFrame:
    return _fetch(binned.filter(F.col("ion_mode") == check_ion_mode(ion_mode)), ids)


def upsert_in_partitions(
    table: DataFrame, batch: DataFrame, partition_by: tuple[str, ...], order_by: list[str]
) -> DataFrame:
    """Insert-or-replace by (partition columns, spectrum_id)."""
    key = [*partition_by, "spectrum_id"]
    last = F.max_by(F.struct(*[c for c in batch.columns if c not in key]), F.struct(*order_by))
    fresh = batch.groupBy(*key).agg(last.alias("_row")).select(*key, "_row.*").select(*table.columns)
    kept = table.join(fresh.select(*key), key, "left_anti").select(*table.columns)
    return kept.unionByName(fresh)


def write_embeddings(table: DataFrame, batch: DataFrame, order_by: list[str]) -> DataFrame:
    return upsert_in_partitions(table, batch, ("project", "ion_mode"), order_by)


def write_binned(table: DataFrame, batch: DataFrame, order_by: list[str]) -> DataFrame:
    return upsert_in_partitions(table, batch, ("ion_mode",), order_by)


def delete_spectra(store: DataFrame, ids: DataFrame) -> DataFrame:
    return store.join(_ids(ids), "spectrum_id", "left_anti").select(*store.columns)


def delete_embeddings(embeddings: DataFrame, project: str, ion_mode: str) -> DataFrame:
    """All but one project's embeddings of one ion mode; on files use ``drop_partition``."""
    return embeddings.filter(
        ~((F.col("project") == project) & (F.col("ion_mode") == check_ion_mode(ion_mode)))
    )


def replace_embeddings(spark: SparkSession, embedded: DataFrame, path: str, project: str, ion_mode: str) -> DataFrame:
    """Put ``embedded`` in place of one project's embeddings of one ion mode, also if it is empty."""
    embedded = materialise(embedded, "embeddings")
    drop_partition(spark, path, project=project, ion_mode=ion_mode)
    embedded.write.mode("append").partitionBy("project", "ion_mode").parquet(path)
    stored = spark.read.schema(embedded.schema).parquet(path)
    return stored.filter((F.col("project") == project) & (F.col("ion_mode") == ion_mode))
