"""From raw records to clean spectra: narrow projections and filters only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from specloom.functions import peaks as P
from specloom.functions import text as X
from specloom.schema import RAW_COLUMNS, check_ion_mode, require_columns

# Fixed value: mass of a proton in Dalton.
PROTON_MASS = 1.00727645199076


def settle(df: DataFrame, *columns: str) -> DataFrame:
    """Compute the columns here, once.

    Catalyst copies a projected expression into every later use of it. That is
    right for cheap ones; long ones are better held behind a generator.
    """
    rest = [c for c in df.columns if c not in columns]
    held = df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("_held"))
    return held.select(*[F.col(f"_held.{c}") if c in columns else F.col(c) for c in df.columns])


def filter_ion_mode(raw: DataFrame, ion_mode: str) -> DataFrame:
    """Raw records of one ion mode; the column's case does not matter."""
    return raw.filter(F.lower("Ion_Mode") == check_ion_mode(ion_mode))


def parse_spectrum(raw: DataFrame) -> DataFrame:
    """Raw records (all text) to spectra; records without usable peaks are dropped.

    The structure key is the first defined one of the two keys a record holds.
    """
    require_columns(raw, RAW_COLUMNS)
    kept = [name for name in RAW_COLUMNS if name != "peaks_json"]
    metadata = F.expr(f"map({', '.join(f"'{c.lower()}', `{c}`" for c in kept)})")
    first, second = F.col("InChIKey_inchi"), F.col("InChIKey_smiles")
    key = F.when(X.is_defined(first), first).when(X.is_defined(second), second)
    return raw.select(
        "spectrum_id",
        X.number(F.col("Precursor_MZ")).alias("precursor_mz"),
        F.col("Charge").alias("charge"),
        F.col("Ion_Mode").alias("ion_mode"),
        F.col("ExactMass").alias("exact_mass"),
        F.lit(None).cast("double").alias("parent_mass"),
        F.col("Adduct").alias("adduct"),
        F.col("Compound_Name").alias("compound_name"),
        F.col("Smiles").alias("smiles"),
        F.col("INCHI").alias("inchi"),
        key.alias("inchikey"),
        F.explode(P.usable_peaks(F.col("peaks_json"))).alias("peaks"),
        metadata.alias("metadata"),
    )


def normalise_metadata(spectra: DataFrame) -> DataFrame:
    """Charge to a signed integer, ion mode to lower case, adduct without brackets.

    A missing ion mode follows the charge's sign; a charge of zero or of the
    wrong sign follows the ion mode.
    """
    spectra = settle(spectra.withColumn("charge", X.charge_number(F.col("charge"))), "charge")
    charge = F.col("charge")
    mode = F.lower(F.trim("ion_mode"))
    by_charge = F.when(charge > 0, "positive").when(charge < 0, "negative").otherwise("n/a")
    known = F.when(mode.isin("positive", "negative"), mode).otherwise(by_charge)
    signed = (
        F.when(known == "positive", F.greatest(F.abs(charge), F.lit(1)))
        .when(known == "negative", -F.greatest(F.abs(charge), F.lit(1)))
        .otherwise(charge)
    )
    return spectra.withColumns(
        {
            "charge": signed.cast("int"),
            "ion_mode": known,
            "adduct": X.bare_adduct(F.col("adduct")),
            "compound_name": F.trim("compound_name"),
        }
    )


def drop_negative_intensity(spectra: DataFrame) -> DataFrame:
    return spectra.filter(~P.any_negative(F.col("peaks")))


def drop_empty_spectra(spectra: DataFrame) -> DataFrame:
    return spectra.filter(P.any_positive(F.col("peaks")))


def derive_parent_mass(spectra: DataFrame) -> DataFrame:
    """The exact mass where it is positive, else computed from precursor m/z and charge."""
    exact = X.number(F.col("exact_mass"))
    charge = F.col("charge")
    computed = F.when(
        charge != 0,
        (F.col("precursor_mz") - F.signum(charge.cast("double")) * F.lit(PROTON_MASS)) * F.abs(charge),
    )
    return spectra.withColumn("parent_mass", F.coalesce(F.when(exact > 0, exact), computed))


def harmonise_undefined(spectra: DataFrame) -> DataFrame:
    return spectra.withColumns({c: X.defined(F.col(c)) for c in ("inchikey", "inchi", "smiles")})


def repair_identifiers(spectra: DataFrame) -> DataFrame:
    """Move an identifier found in the wrong column to the right one."""
    spectra = settle(spectra, "inchi", "inchikey", "smiles")

    def is_inchi(name):
        return F.col(name).rlike(X.INCHI_PATTERN)

    def is_key(name):
        return F.col(name).rlike(X.INCHIKEY_PATTERN)

    def first_match(test, names, fallback):
        return reduce(
            lambda chain, name: chain.when(test(name), F.trim(name)), names, F
        ).otherwise(fallback)

    own_inchi = F.when(is_key("inchi"), F.lit("")).otherwise(F.col("inchi"))
    own_key = F.when(is_inchi("inchikey"), F.lit("")).otherwise(F.col("inchikey"))
    own_smiles = F.when(is_inchi("smiles") | is_key("smiles"), F.lit("")).otherwise(F.col("smiles"))
    return spectra.withColumns(
        {
            "inchi": first_match(is_inchi, ["inchi", "smiles", "inchikey"], own_inchi),
            "inchikey": first_match(is_key, ["inchikey", "inchi", "smiles"], own_key),
            "smiles": own_smiles,
        }
    )


def clean_spectra(spectra: DataFrame) -> DataFrame:
    """All cleaning steps in order; one stage, no shuffle."""
    return (
        spectra.transform(normalise_metadata)
        .transform(drop_negative_intensity)
        .transform(drop_empty_spectra)
        .transform(derive_parent_mass)
        .transform(harmonise_undefined)
        .transform(repair_identifiers)
    )


def normalise_intensities(spectra: DataFrame) -> DataFrame:
    scaled = spectra.withColumn("peaks", P.scale_to_maximum(F.col("peaks")))
    return settle(scaled, "peaks")


def select_by_mz(spectra: DataFrame, low: float = P.MZ_MIN, high: float = P.MZ_MAX) -> DataFrame:
    return spectra.withColumn("peaks", P.within_mz(F.col("peaks"), low, high))


def require_min_peaks(spectra: DataFrame, n_required: int = 5) -> DataFrame:
    """Keep spectra with at least ``n_required`` peaks of positive intensity."""
    return spectra.filter(P.positive_count(F.col("peaks")) >= n_required)


def require_more_than_n_peaks(spectra: DataFrame, min_peaks: int = 0) -> DataFrame:
    """Keep spectra with more than ``min_peaks`` peaks, zeros counted too."""
    return spectra.filter(F.size("peaks") > min_peaks)


def require_structure(spectra: DataFrame) -> DataFrame:
    """Keep spectra with a structure key and an InChI; tidy the InChI."""
    return spectra.filter((F.length("inchikey") > 13) & (F.col("inchi") != "")).withColumn(
        "inchi", F.translate("inchi", '" ', "")
    )


def clean_compound_name(spectra: DataFrame) -> DataFrame:
    return spectra.withColumn("compound_name", X.tidy_compound_name(F.col("compound_name")))


def process_spectra(spectra: DataFrame, is_reference: bool = True) -> DataFrame:
    """Preparation for binning; only library spectra need a known structure."""
    processed = (
        spectra.transform(normalise_intensities).transform(select_by_mz).transform(require_min_peaks)
    )
    return processed.transform(require_structure) if is_reference else processed


def precursor_completeness(raw: DataFrame) -> DataFrame:
    """Share of records that hold a precursor m/z, and a non-empty one, in percent."""
    present = F.col("Precursor_MZ").isNotNull()
    filled = present & (F.trim("Precursor_MZ") != "")
    return raw.agg(
        F.count("*").alias("n_records"),
        (100 * F.avg(present.cast("double"))).alias("present_percentage"),
        (100 * F.avg(F.coalesce(filled, F.lit(False)).cast("double"))).alias("filled_percentage"),
    )


def batch_row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows after each named step, as one report."""
    tagged = [df.select(F.lit(name).alias("stage")) for name, df in stages.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("stage").agg(F.count("*").alias("n_rows"))
