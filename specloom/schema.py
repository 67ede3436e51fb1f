"""Record layouts shared by all modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# The keys of a raw library record, in file order.
RAW_KEYS = [
    "spectrum_id",
    "source_file",
    "task",
    "scan",
    "ms_level",
    "library_membership",
    "spectrum_status",
    "peaks_json",
    "splash",
    "submit_user",
    "Compound_Name",
    "Ion_Source",
    "Compound_Source",
    "Instrument",
    "PI",
    "Data_Collector",
    "Adduct",
    "Scan",
    "Precursor_MZ",
    "ExactMass",
    "Charge",
    "CAS_Number",
    "Pubmed_ID",
    "Smiles",
    "INCHI",
    "INCHI_AUX",
    "Library_Class",
    "SpectrumID",
    "Ion_Mode",
    "create_time",
    "task_id",
    "user_id",
    "InChIKey_smiles",
    "InChIKey_inchi",
    "Formula_smiles",
    "Formula_inchi",
    "url",
]
ION_MODES = ("positive", "negative")

# "scan" and "Scan" differ only in case, so the second is renamed once read.
RENAMED_KEYS = {"Scan": "scan_no"}
RAW_COLUMNS = [RENAMED_KEYS.get(key, key) for key in RAW_KEYS]

PEAKS = T.ArrayType(
    T.StructType([T.StructField("mz", T.DoubleType()), T.StructField("intensity", T.DoubleType())])
)

SPECTRUM_SCHEMA = T.StructType(
    [
        T.StructField("spectrum_id", T.StringType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("charge", T.StringType()),
        T.StructField("ion_mode", T.StringType()),
        T.StructField("exact_mass", T.StringType()),
        T.StructField("parent_mass", T.DoubleType()),
        T.StructField("adduct", T.StringType()),
        T.StructField("compound_name", T.StringType()),
        T.StructField("smiles", T.StringType()),
        T.StructField("inchi", T.StringType()),
        T.StructField("inchikey", T.StringType()),
        T.StructField("peaks", PEAKS),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail early when a column is absent."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def check_ion_mode(ion_mode: str) -> str:
    if ion_mode not in ION_MODES:
        raise ValueError(f"ion_mode must be one of {ION_MODES}, got {ion_mode!r}")
    return ion_mode
