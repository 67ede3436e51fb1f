"""Small frames for the tests."""

from specloom.schema import RAW_COLUMNS, SPECTRUM_SCHEMA

DEFAULTS = {
    "precursor_mz": 200.0,
    "charge": "1",
    "ion_mode": "Positive",
    "exact_mass": "0",
    "parent_mass": None,
    "adduct": "[M+H]",
    "compound_name": "a compound",
    "smiles": "C",
    "inchi": "InChI=1S/C",
    "inchikey": "ABCDEFGHIJKLMN-ABCDEFGHIJ-N",
    "peaks": [(100.0, 1.0)],
    "metadata": {"compound_name": "a compound"},
}


def spectra(spark, *rows):
    """Spectra from dicts; what a row does not name takes the default."""
    names = SPECTRUM_SCHEMA.fieldNames()
    full = [{"spectrum_id": f"s{i}", **DEFAULTS, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in full], SPECTRUM_SCHEMA)


def raw(spark, *rows):
    """Raw records from dicts; what a row does not name is "N/A"."""
    full = [{**dict.fromkeys(RAW_COLUMNS, "N/A"), "spectrum_id": f"s{i}", **row} for i, row in enumerate(rows)]
    schema = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS) for row in full], schema)


def column(df, name):
    return [row[name] for row in df.orderBy("spectrum_id").collect()]


def pairs(df, *names):
    return sorted(tuple(row[n] for n in names) for row in df.collect())
