"""The binned route: prepare training tables, index, search."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.functions.peaks import DEFAULT_BINS
from specloom.operators.binning import bin_peaks, fit_bin_vocabulary
from specloom.operators.candidates import apply_on_empty, require_candidates, union_candidates
from specloom.operators.cleaning import process_spectra
from specloom.operators.keys import lookup_join
from specloom.operators.models import DenseLayer, embed_binned
from specloom.operators.ranking import DEFAULT_N_BEST, attach_metadata
from specloom.operators.similarity import BLOCK_ROWS, blockwise_best
from specloom.operators.structures import (
    group_split,
    spectra_for_keys,
    tanimoto_matrix,
    with_structure_key,
)
from specloom.session import materialise
from specloom.sources.keyed import KeyedTable

PROJECT = "ms2deepscore"


@dataclass
class TrainingTables:
    """What a training run reads."""

    binned: DataFrame
    vocabulary: DataFrame
    scores: DataFrame
    split: DataFrame

    def spectra(self, split: str) -> DataFrame:
        """Binned spectra of one part of the split."""
        return spectra_for_keys(self.binned, self.split.filter(F.col("split") == split))


def ms2ds_prepare(
    spectra: DataFrame,
    fingerprints: DataFrame,
    n_bins: int = DEFAULT_BINS,
    train: float = 0.9,
    validation: float = 0.05,
    min_score: float = 0.0,
    scores_decimals: int = 5,
    seed: int = 100,
) -> TrainingTables:
    """Clean spectra and structure fingerprints to the tables of a training run.

    Binned spectra feed several results, so they are written once.
    """
    binned = materialise(
        spectra.transform(process_spectra)
        .transform(bin_peaks, n_bins)
        .transform(with_structure_key)
        .select("spectrum_id", "key", "inchi", "ion_mode", "bins"),
        "binned",
    )
    keys = binned.select("key").distinct()
    used = fingerprints.join(keys, "key", "left_semi")
    return TrainingTables(
        binned=binned,
        vocabulary=fit_bin_vocabulary(binned),
        scores=tanimoto_matrix(used, min_score, scores_decimals),
        split=group_split(used, train, validation, seed),
    )


def ms2ds_index(
    spark: SparkSession,
    binned: DataFrame,
    vocabulary: DataFrame,
    layers: list[DenseLayer],
    ion_mode: str,
    embeddings_path: str,
    n_bins: int = DEFAULT_BINS,
    n_buckets: int = 64,
) -> DataFrame:
    """Swap one ion mode's embeddings in a keyed table at once; Spark's partitions serve as chunks of ids."""
    mine = binned.filter(F.col("ion_mode") == ion_mode)
    embedded = embed_binned(mine, vocabulary, layers, n_bins).select(
        "spectrum_id", "vector", F.lit(PROJECT).alias("project"), F.lit(ion_mode).alias("ion_mode")
    )
    embeddings = KeyedTable.open(spark, embeddings_path, embedded.schema, ("project", "ion_mode"), n_buckets, filters=False)
    embeddings.replace(embedded, project=PROJECT, ion_mode=ion_mode)
    return embeddings.read(project=PROJECT, ion_mode=ion_mode)


def ms2ds_search(
    queries: DataFrame,
    refs: DataFrame,
    mz_range: float = 1.0,
    n_best_spectra: int | None = DEFAULT_N_BEST,
    on_empty: str = "raise",
    by: tuple[str, ...] = ("ion_mode",),
    metadata: DataFrame | None = None,
    include_metadata: list[str] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Best references among the candidates of *all* queries of the same request.

    ``queries`` also holds ``request_id``. Each query meets its request's
    distinct candidates only, also a query that has none of its own; crowded
    requests are cut into blocks. A query without own candidates raises, by default.
    """
    if on_empty == "raise":
        require_candidates(queries, refs, mz_range, by)
    union = materialise(union_candidates(queries, refs, mz_range, by), "candidates")
    vectors = materialise(
        lookup_join(union, refs.select("ref_id", "ref_vector", *by), ["ref_id"], ["request_id"]),
        "candidate-vectors",
    )
    matches = blockwise_best(
        queries, vectors, ["request_id", *by], n_best_spectra or DEFAULT_N_BEST, block_rows=block_rows
    )
    if on_empty == "keep":
        matches = apply_on_empty(queries.select("query_id"), matches, "keep")
    if metadata is not None:
        matches = attach_metadata(materialise(matches, "matches"), metadata, include_metadata)
    return matches
