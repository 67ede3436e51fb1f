import math

import pytest

from checks import tables
from specloom.operators import documents, models
from tests.helpers import column, pairs, spectra


def test_words_round_half_up(spark):
    df = spectra(spark, {"peaks": [(9.0, 1.0), (100.005, 4.0), (100.0149, 2.0)]})
    row = documents.create_documents(df).first()
    assert row["words"] == ["peak@9.00", "peak@100.01", "peak@100.01"]
    assert row["weights"] == [0.25, 1.0, 0.5]
    assert documents.create_documents(df, 0).first()["words"] == ["peak@9", "peak@100", "peak@100"]
    assert documents.create_documents(df, 4).first()["words"][2] == "peak@100.0149"


def test_one_document_per_spectrum(spark):
    df = spectra(spark, {}, {"peaks": []}, {"peaks": [(1.0, 1.0), (2.0, 1.0)]})
    assert column(documents.create_documents(df), "spectrum_id") == ["s0", "s2"]
    assert column(documents.create_documents(df, 2, 1), "spectrum_id") == ["s2"]


def test_other_decimals_are_refused(spark):
    docs = documents.create_documents(spectra(spark, {}), 2)
    assert documents.check_n_decimals(docs, 2).count() == 1
    with pytest.raises(ValueError):
        documents.check_n_decimals(docs, 1)


def vectors(spark):
    return spark.createDataFrame(
        [("peak@1.00", [1.0, 0.0]), ("peak@2.00", [0.5, 2.0])], "word string, vector array<double>"
    )


def test_weighted_vector_and_coverage(spark):
    df = spectra(spark, {"peaks": [(1.0, 1.0), (2.0, 0.25), (3.0, 0.25)]}, {"peaks": [(3.0, 1.0)]})
    docs = documents.create_documents(df)
    plain = documents.weighted_document_vector(docs, vectors(spark)).collect()
    assert [(r["spectrum_id"], r["vector"]) for r in plain] == [("s0", [1.25, 1.0])]
    rows = {r["spectrum_id"]: r for r in documents.embed_documents(docs, vectors(spark), 0.5, 30.0).collect()}
    assert rows["s0"]["vector"] == [1.25, 1.0]
    assert rows["s0"]["missing_percentage"] == pytest.approx(25.0)
    assert rows["s0"]["status"] == "ok"
    assert rows["s1"]["vector"] == [0.0, 0.0]
    assert rows["s1"]["status"] == "too_many_missing"
    covered = documents.document_coverage(docs, vectors(spark), 0.5, 20.0)
    assert pairs(covered, "spectrum_id", "status") == [("s0", "too_many_missing"), ("s1", "too_many_missing")]


def test_hot_word_does_not_change_the_result(spark, monkeypatch):
    df = spectra(spark, *[{"peaks": [(1.0, 1.0), (2.0 + i % 3, 1.0)]} for i in range(60)])
    docs = documents.create_documents(df)
    expected = pairs(documents.embed_documents(docs, vectors(spark), dim=2), "spectrum_id", "vector", "missing_percentage")
    monkeypatch.setattr(documents, "VECTOR_BYTES", 0)  # too many words for every executor
    original = documents.lookup_join
    monkeypatch.setattr(documents, "lookup_join", lambda *a, broadcast_rows: original(*a, target_rows=7))
    assert (
        pairs(documents.embed_documents(docs, vectors(spark), dim=2), "spectrum_id", "vector", "missing_percentage")
        == expected
    )


def test_vocabulary(spark):
    docs = documents.create_documents(spectra(spark, {"peaks": [(1.0, 1.0), (2.0, 1.0)]}, {"peaks": [(1.0, 3.0)]}))
    assert pairs(documents.word_vocabulary(docs), "word", "n_occurrences") == [("peak@1.00", 2), ("peak@2.00", 1)]
    assert documents.word_vocabulary(docs, 2).count() == 1


def test_training_covers_the_vocabulary(spark):
    df = spectra(spark, *[{"peaks": [(float(i), 1.0), (float(i + 1), 1.0)]} for i in range(1, 8)])
    docs = documents.create_documents(df, 0)
    trained = models.train_word_vectors(docs, vector_size=5, epochs=2, window=5)
    assert pairs(trained, "word") == sorted({(f"peak@{i}",) for i in range(1, 9)})
    assert all(len(r["vector"]) == 5 and not any(map(math.isnan, r["vector"])) for r in trained.collect())
    embedded = documents.embed_documents(docs, trained)
    assert embedded.filter("status = 'ok' and missing_percentage = 0").count() == 7


def test_embedding_shuffles_no_peak_at_300_dimensions(spark):
    df = spectra(spark, *[{"peaks": [(float(i), 1.0), (float(i + 1), 2.0)]} for i in range(1, 30)], {"peaks": [(900.0, 1.0)]})
    docs = documents.create_documents(df, 0)
    table = spark.createDataFrame([(f"peak@{i}", [float(i)] * 300) for i in range(1, 31)], "word string, vector array<double>")
    embedded = documents.embed_documents(docs, table, 1.0)
    assert "Exchange" not in embedded._jdf.queryExecution().executedPlan().toString()
    rows = {r["spectrum_id"]: r for r in embedded.collect()}
    assert rows["s0"]["vector"] == [0.5 * 1 + 1.0 * 2] * 300
    assert (rows["s29"]["status"], rows["s29"]["missing_percentage"]) == ("too_many_missing", 100.0)


def test_words_and_bins_do_not_store_metadata(spark, monkeypatch):
    monkeypatch.setattr(tables, "_stored", {})
    sf = "/root/testdata/sf0.001"
    alone = tables.documents(spark, sf), tables.binned(spark, sf, 100)
    assert not [k for k in tables._stored if k[2] == "spectra"]
    monkeypatch.setattr(tables, "_stored", {})
    tables.spectra(spark, sf)
    beside = tables.documents(spark, sf), tables.binned(spark, sf, 100)
    assert not [k for k in tables._stored if k[2] == "peak-spectra"]
    for a, b in zip(alone, beside):
        assert sorted(a.columns) == sorted(b.columns) and a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_a_single_pass_stores_no_library(spark, monkeypatch):
    monkeypatch.setattr(tables, "_stored", {})
    sf = "/root/testdata/sf0.001"
    alone = tables.binned(spark, sf, 100)
    assert [k[2] for k in tables._stored] == ["binned-100"]
    assert "Broadcast" not in tables.derive_raw(spark, sf)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tables, "_stored", {})
    tables.raw(spark, sf), tables.peak_spectra(spark, sf)
    beside = tables.binned(spark, sf, 100)
    assert alone.count() == beside.count() and alone.exceptAll(beside).isEmpty()
