"""Queries with one pass over the library derive it on the way."""

import pytest

from checks import queries, tables

SF = "/root/testdata/sf0.001"


def stored_by(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "_stored", {})
    found = queries.REGISTRY[name](spark, SF)
    return found, [k[2] for k in tables._stored]


@pytest.mark.parametrize("name", ["parse_spectrum", "read_library_mgf", "prepare_library"])
def test_nothing_is_stored(spark, monkeypatch, name):
    found, stored = stored_by(spark, monkeypatch, name)
    assert stored == [] and found.count() > 0


def test_training_tables_store_no_metadata(spark, monkeypatch):
    _, stored = stored_by(spark, monkeypatch, "ms2ds_prepare")
    assert "spectra" not in stored and "raw" not in stored


def test_metadata_is_attached_from_a_library_that_is_not_stored(spark, monkeypatch):
    found, stored = stored_by(spark, monkeypatch, "attach_metadata")
    assert stored == ["embeddings"] and found.count() > 0
