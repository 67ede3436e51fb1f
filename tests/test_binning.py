import numpy as np
import pytest

from specloom.operators import binning, models
from tests.helpers import pairs, spectra


def test_largest_value_per_bin(spark):
    df = spectra(
        spark, {"peaks": [(9.0, 1.0), (10.0, 0.25), (19.8, 0.5), (19.85, 1.0), (999.99, 0.04), (1000.0, 1.0)]}
    )
    got = binning.bin_rows(binning.bin_peaks(df, 100)).collect()
    assert [(r["bin"], round(r["value"], 9)) for r in got] == [(0, 1.0), (99, 0.2)]


def frame(spark):
    df = spectra(spark, {"peaks": [(10.5, 1.0), (500.0, 0.25)]}, {"peaks": [(10.6, 0.25), (900.0, 1.0)]})
    binned = binning.bin_peaks(df, 100)
    return binned, binning.fit_bin_vocabulary(binned.filter("spectrum_id = 's0'"))


def test_vocabulary_positions_and_unseen_share(spark):
    binned, vocabulary = frame(spark)
    assert pairs(vocabulary, "bin", "position") == [(0, 0), (49, 1)]
    assert pairs(binning.transform_to_vocabulary(binned, vocabulary), "spectrum_id", "position", "value") == [
        ("s0", 0, 1.0),
        ("s0", 1, 0.5),
        ("s1", 0, 0.5),
    ]
    assert pairs(binning.unseen_bin_share(binned, vocabulary), "spectrum_id", "unseen_share") == [
        ("s0", 0.0),
        ("s1", pytest.approx(2 / 3)),
    ]


def test_dense_vectors(spark):
    binned, vocabulary = frame(spark)
    assert pairs(binning.densify_binned(binned, vocabulary, 100), "spectrum_id", "vector") == [
        ("s0", [1.0, 0.5]),
        ("s1", [0.5, 0.0]),
    ]


def test_network_equals_dense_arithmetic(spark):
    rng = np.random.default_rng(3)
    df = spectra(
        spark,
        *[
            {"peaks": [(float(m), float(i)) for m, i in zip(np.sort(rng.uniform(5, 1005, 30)), rng.uniform(0, 1, 30))]}
            for _ in range(25)
        ],
        {"peaks": [(5.0, 1.0)]},
    )
    binned = binning.bin_peaks(df, 100)
    vocabulary = binning.fit_bin_vocabulary(binned)
    n = vocabulary.count()
    layers = [
        models.DenseLayer(rng.normal(size=(n, 7)), rng.normal(size=7), "relu", rng.normal(size=7), rng.normal(size=7)),
        models.DenseLayer(rng.normal(size=(7, 3)), rng.normal(size=3), "linear"),
    ]
    dense = {r["spectrum_id"]: np.array(r["vector"]) for r in binning.densify_binned(binned, vocabulary, 100).collect()}
    got = {r["spectrum_id"]: np.array(r["vector"]) for r in models.embed_binned(binned, vocabulary, layers, 100).collect()}
    assert got.keys() == dense.keys() and len(got) == 26
    for key, x in dense.items():
        hidden = np.maximum(x @ layers[0].weights + layers[0].bias, 0) * layers[0].scale + layers[0].shift
        np.testing.assert_allclose(got[key], hidden @ layers[1].weights + layers[1].bias)
