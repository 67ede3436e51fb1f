"""Preparing a library."""

from __future__ import annotations

from pyspark.sql import DataFrame

from specloom.operators.cleaning import clean_spectra, filter_ion_mode, parse_spectrum
from specloom.sources.datasets import write_dataset


def prepare_library(raw: DataFrame, ion_mode: str | None = None, path: str | None = None) -> DataFrame:
    """Raw records to clean spectra, of one ion mode or of all; optionally written.

    One narrow plan: the scan, the filters and the projections form one stage.
    """
    if ion_mode is not None:
        raw = filter_ion_mode(raw, ion_mode)
    spectra = raw.transform(parse_spectrum).transform(clean_spectra)
    if path is None:
        return spectra
    write_dataset(spectra, path)
    return spectra.sparkSession.read.parquet(path)
