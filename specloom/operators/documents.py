"""Spectra as documents of peak words, and their vectors."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from specloom.functions import peaks as P
from specloom.operators.binning import list_column, owners
from specloom.operators.cleaning import normalise_intensities, require_more_than_n_peaks
from specloom.operators.keys import lookup_join


def peak_documents(spectra: DataFrame, n_decimals: int = 2) -> DataFrame:
    """Replace the peaks of normalised spectra by words and weights."""
    return spectra.withColumns(
        {
            "n_decimals": F.lit(n_decimals),
            "words": P.peak_words(F.col("peaks"), n_decimals),
            "weights": P.intensities(F.col("peaks")),
        }
    ).drop("peaks")


def create_documents(spectra: DataFrame, n_decimals: int = 2, min_peaks: int = 0) -> DataFrame:
    """One document per spectrum with more than ``min_peaks`` peaks."""
    return (
        spectra.transform(require_more_than_n_peaks, min_peaks)
        .transform(normalise_intensities)
        .transform(peak_documents, n_decimals)
    )


def decimals_report(documents: DataFrame, n_decimals: int) -> DataFrame:
    """Documents per ``n_decimals``, and whether a model of ``n_decimals`` takes them."""
    return documents.groupBy("n_decimals").agg(
        F.count("*").alias("n_documents"),
        F.first(F.col("n_decimals") == n_decimals).alias("accepted"),
    )


def check_n_decimals(documents: DataFrame, n_decimals: int) -> DataFrame:
    """Refuse documents made with another number of decimals than the model's."""
    if not documents.filter(F.col("n_decimals") != n_decimals).isEmpty():
        raise ValueError(f"documents must have n_decimals={n_decimals}, as the model")
    return documents


def power_weights(documents: DataFrame, exponent: float = 0.5) -> DataFrame:
    return documents.withColumn("weights", P.power(F.col("weights"), exponent))


def word_rows(documents: DataFrame, exponent: float = 0.5) -> DataFrame:
    """(spectrum_id, position, word, weight), the weight powered."""
    return documents.select(
        "spectrum_id", F.posexplode(F.arrays_zip("words", "weights")).alias("position", "entry")
    ).select(
        "spectrum_id",
        "position",
        F.col("entry.words").alias("word"),
        F.pow("entry.weights", F.lit(float(exponent))).alias("weight"),
    )


def word_vocabulary(documents: DataFrame, min_count: int = 1) -> DataFrame:
    """Corpus frequency of each word."""
    return (
        documents.select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n_occurrences"))
        .filter(F.col("n_occurrences") >= min_count)
    )


# What a broadcast of words or of word vectors may take.
BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes of a word in a broadcast table, generously.
_WORD_BYTES = 64


def _join_words(rows: DataFrame, table: DataFrame, how: str, dim: int = 0) -> DataFrame:
    """Look words up in a table whose size decides between broadcast and shuffle."""
    return lookup_join(
        rows,
        table,
        ["word"],
        ["spectrum_id", "position"],
        how,
        broadcast_rows=BROADCAST_BYTES // (_WORD_BYTES + 8 * dim),
    )


def _missing_share():
    missing = F.sum(F.when(F.col("_known").isNull(), F.col("weight")).otherwise(0.0))
    return 100 * F.coalesce(F.try_divide(missing, F.sum("weight")), F.lit(0.0))


def _status(allowed):
    return F.when(F.col("missing_percentage") > allowed, "too_many_missing").otherwise("ok")


def document_coverage(
    documents: DataFrame,
    vocabulary: DataFrame,
    exponent: float = 0.5,
    allowed_missing_percentage: float = 5.0,
) -> DataFrame:
    """Share of a document's weight on words the vocabulary lacks, in percent."""
    known = vocabulary.select("word", F.lit(True).alias("_known"))
    return (
        _join_words(word_rows(documents, exponent), known, "left")
        .groupBy("spectrum_id")
        .agg(_missing_share().alias("missing_percentage"))
        .withColumn("status", _status(allowed_missing_percentage))
    )


# What the table of word vectors may take on the driver and, once, on each executor. m/z limits and decimals bound
# the words: 200,000 of them with 300 dimensions take 480 MB.
VECTOR_BYTES = 512 * 1024 * 1024

# Entries (word and vector) that a task holds at once, in numbers.
_ENTRIES_AT_ONCE = 4_000_000


def _vector_table(word_vectors: DataFrame, dim: int):
    """The words and their vectors for all executors; None if there are too many."""
    limit = VECTOR_BYTES // (_WORD_BYTES + 8 * max(dim, 1))
    rows = word_vectors.select("word", F.col("vector").cast("array<double>").alias("vector"))
    if rows.limit(limit + 1).count() > limit:
        return None
    table = rows.toArrow().combine_chunks()
    words = pa.concat_arrays(table.column("word").chunks) if table.num_rows else pa.array([], pa.string())
    vectors = np.zeros((0, dim))
    if table.num_rows:
        vectors = np.array(pa.concat_arrays(table.column("vector").chunks).flatten()).reshape(table.num_rows, -1)[:, :dim]
    return word_vectors.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, words, vectors))


def _cut(batches, dim: int):
    """Pieces of batches whose entries fit in memory, each with at least one document."""
    most = max(1, _ENTRIES_AT_ONCE // max(dim, 1))
    for batch in batches:
        ends = np.cumsum(np.array(pc.list_value_length(batch.column("words")).fill_null(0)))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most, "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


# Of the last word table that this worker used: its name, and each word's row.
_rows_of_words: tuple[str, dict[str, int]] = ("", {})


def _places(words: pa.Array, name: str, table: pa.Array) -> np.ndarray:
    """Each word's row in the table, -1 if it has none; the table is hashed once per worker, not once per batch."""
    global _rows_of_words
    if _rows_of_words[0] != name:
        _rows_of_words = name, {w: i for i, w in enumerate(table.to_pylist())}
    rows, coded = _rows_of_words[1], words.dictionary_encode()
    found = np.array([rows.get(w, -1) for w in coded.dictionary.to_pylist()], np.int64)
    # A null word has no row; the entry behind the last one stands for it.
    return np.append(found, -1)[coded.indices.fill_null(len(found)).to_numpy(zero_copy_only=False)]


def _summed(shared, dim: int, exponent: float):
    def work(batches):
        name, words, vectors = shared.value
        for part in _cut(batches, dim):
            owner = owners(part.column("weights"))
            weights = np.power(part.column("weights").flatten().to_numpy(zero_copy_only=False), exponent)
            place = _places(part.column("words").flatten(), name, words)
            known = place >= 0
            total = np.bincount(owner, weights=weights, minlength=part.num_rows)
            missing = np.bincount(owner[~known], weights=weights[~known], minlength=part.num_rows)
            sums = np.zeros((part.num_rows, dim))
            if known.any():
                own = owner[known]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                sums[own[first]] = np.add.reduceat(weights[known, None] * vectors[place[known]], first, axis=0)
            share = np.divide(100 * missing, total, out=np.zeros(part.num_rows), where=total != 0)
            n_known = np.bincount(owner[known], minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("spectrum_id"), list_column(sums), pa.array(share), pa.array(n_known)],
                names=["spectrum_id", "vector", "missing_percentage", "n_known"],
            )

    return work


def _embedded(documents: DataFrame, shared, dim: int, exponent: float) -> DataFrame:
    """Vector, missing share and known words of each document that has words: no peak is shuffled."""
    filled = documents.filter(F.size("words") > 0).select("spectrum_id", "words", F.col("weights").cast("array<double>").alias("weights"))
    schema = "spectrum_id string, vector array<double>, missing_percentage double, n_known bigint"
    return filled.mapInArrow(_summed(shared, dim, float(exponent)), schema)


def _vector_sum(dim: int):
    """Per-dimension sums of weight * vector, as plain partial aggregates."""
    return F.array(
        *[
            F.coalesce(F.sum(F.col("weight") * F.get(F.col("vector"), F.lit(i))), F.lit(0.0))
            for i in range(dim)
        ]
    )


def vector_size(vectors: DataFrame) -> int:
    row = vectors.select(F.size("vector").alias("n")).first()
    return row["n"] if row else 0


def weighted_document_vector(
    documents: DataFrame, word_vectors: DataFrame, exponent: float = 0.5, dim: int | None = None
) -> DataFrame:
    """Sum of word vector times powered weight, over the words that have a vector."""
    dim = dim or vector_size(word_vectors)
    shared = _vector_table(word_vectors, dim)
    if shared is not None:
        return _embedded(documents, shared, dim, exponent).filter("n_known > 0").select("spectrum_id", "vector")
    joined = _join_words(
        word_rows(documents, exponent), word_vectors.select("word", "vector"), "inner", dim
    )
    return joined.groupBy("spectrum_id").agg(_vector_sum(dim).alias("vector"))


def embed_documents(
    documents: DataFrame,
    word_vectors: DataFrame,
    exponent: float = 0.5,
    allowed_missing_percentage: float = 5.0,
    dim: int | None = None,
) -> DataFrame:
    """Vectors and coverage, summed where the document lies.

    The table of word vectors goes to every executor if it is small enough;
    beyond that, words are joined to it by shuffle. A document above the allowed share keeps its row with the status
    ``too_many_missing``, so one poor spectrum does not stop a library.
    """
    dim = dim or vector_size(word_vectors)
    shared = _vector_table(word_vectors, dim)
    if shared is not None:
        embedded = _embedded(documents, shared, dim, exponent).drop("n_known")
        return embedded.withColumn("status", _status(allowed_missing_percentage))
    known = word_vectors.select("word", "vector", F.lit(True).alias("_known"))
    return (
        _join_words(word_rows(documents, exponent), known, "left", dim)
        .groupBy("spectrum_id")
        .agg(
            _vector_sum(dim).alias("vector"),
            _missing_share().alias("missing_percentage"),
        )
        .withColumn("status", _status(allowed_missing_percentage))
    )
