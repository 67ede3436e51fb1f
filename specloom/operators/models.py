"""Model steps: word vectors and a dense network over binned spectra."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from specloom.functions.peaks import DEFAULT_BINS
from specloom.operators.binning import known_entries, list_column, row_slices, vocabulary_lookup


def train_word_vectors(
    documents: DataFrame,
    vector_size: int = 300,
    window: int = 500,
    epochs: int = 25,
    min_count: int = 1,
    seed: int = 42,
    n_partitions: int | None = None,
) -> DataFrame:
    """(word, vector) learnt from peak documents by Spark ML.

    The model's size is the vocabulary's, which rounding the m/z bounds; the
    documents stay distributed. Longer documents than the sentence limit would
    be cut, so the limit is set beyond any spectrum.
    """
    spark = documents.sparkSession
    model = Word2Vec(
        inputCol="words",
        outputCol="vector",
        vectorSize=vector_size,
        windowSize=window,
        maxIter=epochs,
        minCount=min_count,
        seed=seed,
        numPartitions=n_partitions or spark.sparkContext.defaultParallelism,
        maxSentenceLength=1_000_000,
    ).fit(documents.select("words"))
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


@dataclass(frozen=True)
class DenseLayer:
    """``activation(x @ weights + bias)``, then an optional scale and shift.

    Scale and shift hold a folded batch normalisation.
    """

    weights: np.ndarray
    bias: np.ndarray
    activation: str = "relu"
    scale: np.ndarray | None = None
    shift: np.ndarray | None = None

    def finish(self, product: np.ndarray) -> np.ndarray:
        out = product + self.bias
        if self.activation == "relu":
            out = np.maximum(out, 0.0)
        if self.scale is not None:
            out = out * self.scale
        if self.shift is not None:
            out = out + self.shift
        return out


def _sparse_product(owner, positions, values, n_rows, weights):
    """Rows of sparse (position, value) entries times a dense matrix."""
    out = np.zeros((n_rows, weights.shape[1]))
    if owner.size:
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[starts]] = np.add.reduceat(weights[positions] * values[:, None], starts, axis=0)
    return out


def embed_binned(
    binned: DataFrame, vocabulary: DataFrame, layers: list[DenseLayer], n_bins: int = DEFAULT_BINS
) -> DataFrame:
    """(spectrum_id, vector): a trained network applied to binned spectra.

    The input stays sparse: the first layer adds up only the weight rows of the
    bins present. Weights and vocabulary are fixed by the architecture, not by
    the data, and are sent once per executor; the spectra are not shuffled.
    """
    lookup = vocabulary_lookup(vocabulary, n_bins)
    model = binned.sparkSession.sparkContext.broadcast(layers)

    def embed(batches):
        first, *rest = model.value
        for part in row_slices(batches, 512):
            entries = known_entries(part, lookup.value)
            x = first.finish(_sparse_product(*entries, part.num_rows, first.weights))
            for layer in rest:
                x = layer.finish(x @ layer.weights)
            yield pa.RecordBatch.from_arrays(
                [part.column("spectrum_id"), list_column(x)], names=["spectrum_id", "vector"]
            )

    return binned.select("spectrum_id", "bins").mapInArrow(
        embed, "spectrum_id string, vector array<double>"
    )
