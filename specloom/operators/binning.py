"""Spectra as sparse vectors over fixed-width m/z bins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from specloom.functions import peaks as P


def bin_peaks(spectra: DataFrame, n_bins: int = P.DEFAULT_BINS, exponent: float = 0.5) -> DataFrame:
    """Replace the peaks by ``bins``: array of (bin, value), ascending; stays in the row."""
    return spectra.withColumn("bins", P.binned(F.col("peaks"), n_bins, exponent)).drop("peaks")


def bin_rows(binned: DataFrame) -> DataFrame:
    """Long form: (spectrum_id, bin, value)."""
    return binned.select("spectrum_id", F.inline("bins"))


def fit_bin_vocabulary(binned: DataFrame) -> DataFrame:
    """The bins seen in a corpus, numbered from 0 in ascending order.

    There are at most ``n_bins`` of them, whatever the corpus, so numbering
    them in one window is bounded.
    """
    seen = binned.select(F.explode(F.transform("bins", lambda b: b["bin"])).alias("bin")).distinct()
    return seen.select(
        "bin", (F.row_number().over(Window.orderBy("bin")) - 1).cast("int").alias("position")
    )


def transform_to_vocabulary(binned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(spectrum_id, position, value) of the bins a fitted vocabulary knows.

    The vocabulary has at most ``n_bins`` rows by construction: broadcast.
    """
    return bin_rows(binned).join(F.broadcast(vocabulary), "bin").select("spectrum_id", "position", "value")


def unseen_bin_share(binned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Share of each spectrum's binned weight in bins the vocabulary lacks."""
    unseen = F.sum(F.when(F.col("position").isNull(), F.col("value")).otherwise(0.0))
    return (
        bin_rows(binned)
        .join(F.broadcast(vocabulary), "bin", "left")
        .groupBy("spectrum_id")
        .agg(F.coalesce(F.try_divide(unseen, F.sum("value")), F.lit(0.0)).alias("unseen_share"))
    )


def vocabulary_lookup(vocabulary: DataFrame, n_bins: int = P.DEFAULT_BINS) -> Broadcast:
    """The fitted vocabulary as an array from bin to position, -1 where unknown.

    Its size is ``n_bins``, a parameter, whatever the corpus.
    """
    lookup = np.full(n_bins, -1, dtype=np.int64)
    for row in vocabulary.collect():
        lookup[row["bin"]] = row["position"]
    return vocabulary.sparkSession.sparkContext.broadcast(lookup)


def owners(column: pa.ListArray) -> np.ndarray:
    """The row number of every element of a list column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths)


def ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column as row numbers and flat values."""
    whole = column.combine_chunks()
    return owners(whole), whole.flatten().to_numpy(zero_copy_only=False)


def list_column(matrix: np.ndarray) -> pa.Array:
    """A matrix as a list column, one row each."""
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def row_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def known_entries(batch: pa.RecordBatch, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, vocabulary positions and values of the bins the vocabulary knows."""
    owner = owners(batch.column("bins"))
    entries = batch.column("bins").flatten()
    positions = lookup[entries.field("bin").to_numpy(zero_copy_only=False)]
    known = positions >= 0
    return owner[known], positions[known], entries.field("value").to_numpy(zero_copy_only=False)[known]


def densify_binned(binned: DataFrame, vocabulary: DataFrame, n_bins: int = P.DEFAULT_BINS) -> DataFrame:
    """(spectrum_id, vector) over the vocabulary, zeros filled in; unknown bins are dropped.

    Scatters Arrow batches cut to about 32 MB of output, so a task's memory
    depends neither on the vocabulary nor on the partition.
    """
    lookup = vocabulary_lookup(vocabulary, n_bins)
    dim = int((lookup.value >= 0).sum())
    rows = max(1, 4_000_000 // max(dim, 1))

    def scatter(batches):
        for part in row_slices(batches, rows):
            owner, positions, values = known_entries(part, lookup.value)
            dense = np.zeros((part.num_rows, dim))
            dense[owner, positions] = values
            yield pa.RecordBatch.from_arrays(
                [part.column("spectrum_id"), list_column(dense)], names=["spectrum_id", "vector"]
            )

    return binned.select("spectrum_id", "bins").mapInArrow(
        scatter, "spectrum_id string, vector array<double>"
    )
