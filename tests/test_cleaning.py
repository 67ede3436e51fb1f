import pytest
from pyspark.sql import functions as F

from specloom.operators import cleaning
from specloom.plans.library import prepare_library
from tests.helpers import column, raw, spectra


def mz(row):
    return [p["mz"] for p in row]


def test_mz_bounds_are_inclusive(spark):
    df = spectra(spark, {"peaks": [(9.9999, 1.0), (10.0, 1.0), (1000.0, 1.0), (1000.0001, 1.0)]})
    assert mz(column(cleaning.select_by_mz(df), "peaks")[0]) == [10.0, 1000.0]


def test_minimum_counts_positive_peaks_only(spark):
    four = [(100.0 + i, 1.0) for i in range(4)]
    df = spectra(spark, {"peaks": four}, {"peaks": four + [(200.0, 2.0)]}, {"peaks": four + [(200.0, 0.0)]})
    assert column(cleaning.require_min_peaks(df), "spectrum_id") == ["s1"]
    assert column(cleaning.require_more_than_n_peaks(df, 4), "spectrum_id") == ["s1", "s2"]


def test_negative_and_all_zero_spectra_are_dropped(spark):
    df = spectra(
        spark,
        {"peaks": [(100.0, -10.0), (101.0, 5.0)]},
        {"peaks": [(100.0, 0.0), (101.0, 0.0)]},
        {"peaks": [(100.0, 0.0), (101.0, 3.0)]},
    )
    assert column(cleaning.clean_spectra(df), "spectrum_id") == ["s2"]


def test_normalising_scales_to_one_and_survives_zeros(spark):
    df = spectra(spark, {"peaks": [(1.0, 2.0), (2.0, 4.0)]}, {"peaks": [(1.0, 0.0)]})
    got = column(cleaning.normalise_intensities(df), "peaks")
    assert [[p["intensity"] for p in peaks] for peaks in got] == [[0.5, 1.0], [0.0]]


@pytest.mark.parametrize(
    "charge, mode, number, clean_mode",
    [
        ("1-", "Negative", -1, "negative"),
        ("2+", "POSITIVE", 2, "positive"),
        ("0", "positive", 1, "positive"),
        ("0", "negative", -1, "negative"),
        ("-3", "", -3, "negative"),
        ("1", "negative", -1, "negative"),
        ("N/A", "n/a", 0, "n/a"),
    ],
)
def test_charge_and_mode(spark, charge, mode, number, clean_mode):
    row = cleaning.normalise_metadata(spectra(spark, {"charge": charge, "ion_mode": mode})).first()
    assert (row["charge"], row["ion_mode"], row["adduct"]) == (number, clean_mode, "M+H")


@pytest.mark.parametrize(
    "exact, charge, mode, expected",
    [
        ("N/A", "1-", "negative", 184.06427645199076),
        ("180.5", "1-", "negative", 180.5),
        ("0", "1", "positive", 182.04972354800924),
        (None, "2", "positive", 2 * 182.04972354800924),
    ],
)
def test_parent_mass(spark, exact, charge, mode, expected):
    df = spectra(
        spark, {"exact_mass": exact, "charge": charge, "ion_mode": mode, "precursor_mz": 183.057}
    )
    row = df.transform(cleaning.normalise_metadata).transform(cleaning.derive_parent_mass).first()
    assert row["parent_mass"] == pytest.approx(expected, abs=1e-9)


def test_undefined_identifiers(spark):
    df = spectra(spark, *[{"inchi": v} for v in ("", "N/A", "n/a", None, "InChI=1S/X")])
    assert column(cleaning.harmonise_undefined(df), "inchi") == ["", "", "", "", "InChI=1S/X"]


def test_misplaced_identifiers_are_moved(spark):
    key = "ABCDEFGHIJKLMN-ABCDEFGHIJ-N"
    df = spectra(
        spark,
        {"inchi": key, "inchikey": "", "smiles": "C"},
        {"inchi": "", "inchikey": key, "smiles": "InChI=1S/C2"},
        {"inchi": "InChI=1S/C3", "inchikey": key, "smiles": "CC"},
    )
    got = cleaning.repair_identifiers(df).orderBy("spectrum_id").select("inchi", "inchikey", "smiles").collect()
    assert [tuple(r) for r in got] == [
        ("", key, "C"),
        ("InChI=1S/C2", key, ""),
        ("InChI=1S/C3", key, "CC"),
    ]


def test_structure_is_required_and_tidied(spark):
    df = spectra(
        spark,
        {"inchi": '"InChI=1S/ C2"'},
        {"inchikey": "ABCDEFGHIJKLM"},
        {"inchi": ""},
        {"inchikey": None},
    )
    got = cleaning.require_structure(df)
    assert column(got, "inchi") == ["InChI=1S/C2"]


def test_compound_names(spark):
    names = ["aspirin M+2H/2", "aspirinF dial M", "aspirin", "M", "two words ?"]
    df = spectra(spark, *[{"compound_name": n} for n in names])
    assert column(cleaning.clean_compound_name(df), "compound_name") == [
        "aspirin",
        "aspirin",
        "aspirin",
        "",
        "two words",
    ]


def test_unusable_records_are_dropped_when_parsed(spark):
    df = raw(
        spark,
        {"peaks_json": "[[80.06, 15"},
        {"peaks_json": "[[90.5, 2.0], [80.06, 15]]", "Precursor_MZ": "800", "ExactMass": "N/A"},
        {"peaks_json": "[]"},
        {"peaks_json": "[[80.06]]"},
        {"peaks_json": None},
    )
    got = cleaning.parse_spectrum(df)
    assert column(got, "spectrum_id") == ["s1"]
    row = got.first()
    assert [tuple(p) for p in row["peaks"]] == [(80.06, 15.0), (90.5, 2.0)]
    assert row["precursor_mz"] == 800.0
    assert row["metadata"]["exactmass"] == "N/A"
    assert len(row["metadata"]) == 36


def test_parsing_requires_all_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        cleaning.parse_spectrum(raw(spark, {}).drop("Charge"))


def test_ion_mode_filter(spark):
    df = raw(spark, {"Ion_Mode": "Positive"}, {"Ion_Mode": "NEGATIVE"}, {"Ion_Mode": "negative"})
    assert column(cleaning.filter_ion_mode(df, "negative"), "spectrum_id") == ["s1", "s2"]
    with pytest.raises(ValueError):
        cleaning.filter_ion_mode(df, "Positive")


def test_json_is_parsed_once_and_without_shuffle(spark):
    df = prepare_library(raw(spark, {"peaks_json": "[[80.06, 15]]", "Ion_Mode": "Positive", "Charge": "1"}), "positive")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1


def test_completeness_and_counts(spark):
    df = raw(spark, {"Precursor_MZ": "1"}, {"Precursor_MZ": ""}, {"Precursor_MZ": None}, {"Precursor_MZ": "2"})
    row = cleaning.precursor_completeness(df).first()
    assert (row["n_records"], row["present_percentage"], row["filled_percentage"]) == (4, 75.0, 50.0)
    counts = cleaning.batch_row_counts({"all": df, "some": df.filter(F.col("spectrum_id") > "s1")})
    assert {r["stage"]: r["n_rows"] for r in counts.collect()} == {"all": 4, "some": 2}
