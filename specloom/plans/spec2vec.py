"""The word-vector route: train, index, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.operators.candidates import apply_on_empty, require_candidates
from specloom.operators.documents import create_documents, embed_documents
from specloom.operators.models import train_word_vectors
from specloom.operators.ranking import DEFAULT_N_BEST, attach_metadata
from specloom.operators.similarity import window_best
from specloom.plans.library import prepare_library
from specloom.session import materialise
from specloom.sources.keyed import KeyedTable
from specloom.sources.store import smallest_hash

PROJECT = "spec2vec"


def spec2vec_train(raw: DataFrame, ion_mode: str, n_decimals: int = 2, **training) -> DataFrame:
    """Raw records of one ion mode to word vectors."""
    return (
        raw.transform(prepare_library, ion_mode)
        .transform(create_documents, n_decimals)
        .transform(lambda documents: train_word_vectors(documents, **training))
    )


def embed_spectra(
    spectra: DataFrame,
    word_vectors: DataFrame,
    n_decimals: int = 2,
    exponent: float = 0.5,
    allowed_missing_percentage: float = 5.0,
    dim: int | None = None,
) -> DataFrame:
    """(spectrum_id, vector) of the spectra that the model covers well enough."""
    columns = [c for c in ("spectrum_id", "ion_mode", "precursor_mz", "peaks") if c in spectra.columns]
    documents = create_documents(spectra.select(*columns), n_decimals)
    embedded = embed_documents(documents, word_vectors, exponent, allowed_missing_percentage, dim)
    return embedded.filter(F.col("status") == "ok").select("spectrum_id", "vector")


def spec2vec_index(
    spark: SparkSession,
    spectra: DataFrame,
    word_vectors: DataFrame,
    ion_mode: str,
    spectra_path: str,
    embeddings_path: str,
    n_buckets: int = 64,
    **embedding,
) -> DataFrame:
    """Append unknown spectra to the library and replace one ion mode's embeddings.

    Both paths are keyed tables. Known ids are told by the library's filters of ids, so a
    second run adds nothing and new ids don't move the library. The ion mode's
    embeddings are swapped at once: what can no longer be embedded does not
    stay, and readers see the old ones until the new ones are whole. The other
    partitions of both tables are not touched.
    """
    mine = spectra.filter(F.col("ion_mode") == ion_mode)
    library = KeyedTable.open(spark, spectra_path, mine.schema, ("ion_mode",), n_buckets)
    library.append_new(mine, [smallest_hash(mine)])
    embedded = embed_spectra(mine, word_vectors, **embedding).select(
        "spectrum_id", "vector", F.lit(PROJECT).alias("project"), F.lit(ion_mode).alias("ion_mode")
    )
    embeddings = KeyedTable.open(spark, embeddings_path, embedded.schema, ("project", "ion_mode"), n_buckets, filters=False)
    embeddings.replace(embedded, project=PROJECT, ion_mode=ion_mode)
    return embeddings.read(project=PROJECT, ion_mode=ion_mode)


def spec2vec_search(
    queries: DataFrame,
    refs: DataFrame,
    mz_range: float = 1.0,
    n_best_spectra: int | None = DEFAULT_N_BEST,
    on_empty: str = "raise",
    by: tuple[str, ...] = ("ion_mode",),
    metadata: DataFrame | None = None,
    include_metadata: list[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Best references within the precursor window of each query.

    ``queries`` holds query_id, query_mz, query_vector and the ``by`` columns,
    ``refs`` the same with ``ref_``. Both sides carry their vectors through one
    shuffle on (by, m/z bucket); scoring and ranking happen where they meet
    (``window_best``). A query without candidates raises, by default.
    """
    if on_empty == "raise":
        require_candidates(queries, refs, mz_range, by)
    matches = window_best(queries, refs, list(by), n_best_spectra or DEFAULT_N_BEST, mz_range, block_rows=block_rows)
    if on_empty == "keep":
        matches = apply_on_empty(queries.select("query_id"), matches, "keep")
    if metadata is not None:
        matches = attach_metadata(materialise(matches, "matches"), metadata, include_metadata)
    return matches
