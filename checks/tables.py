"""Library, queries and structures derived from the given tables.

The tables hold no spectra, so orders act as library records, their line items
as peaks, customers as structures, and the embeddings as vectors of the records
with the same number. Everything is derived from whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from specloom.operators.binning import bin_peaks
from specloom.operators.cleaning import process_spectra
from specloom.operators.documents import create_documents
from specloom.plans.library import prepare_library
from specloom.schema import RAW_COLUMNS
from specloom.session import new_path

WORD_DIM = 16
# Ids of at most this many rows, some tens of MB, are sent to the orders.
FEW_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The adapter's expressions are the same text for Spark and for the SQL to compare with.
KEY = (
    "upper(translate(substring(md5(cast(o_custkey as string)), 1, 14), '0123456789', 'ghijklmnop')) || '-' ||"
    " upper(translate(substring(md5(cast(o_custkey as string)), 15, 10), '0123456789', 'ghijklmnop')) || '-N'"
)
NUMBERED = "cast(o_custkey as string)"


def _by_priority(urgent: str, high: str, medium: str, unspecified: str, low: str) -> str:
    return (
        f"case o_orderpriority when '1-URGENT' then {urgent} when '2-HIGH' then {high}"
        f" when '3-MEDIUM' then {medium} when '4-NOT SPECIFIED' then {unspecified} else {low} end"
    )


def id_text(number: str) -> str:
    return f"'SP' || lpad(cast({number} as string), 9, '0')"


LIBRARY_FIELDS = {
    "spectrum_id": id_text("o_orderkey"),
    "precursor_mz": "round(100 + o_totalprice / 1000, 5)",
    "ion_mode": "case o_orderstatus when 'F' then 'negative' else 'positive' end",
}
RAW_FIELDS = {
    "spectrum_id": id_text("o_orderkey"),
    "SpectrumID": id_text("o_orderkey"),
    "Precursor_MZ": "cast(round(100 + o_totalprice / 1000, 5) as string)",
    "ExactMass": _by_priority(
        "'N/A'", "'0'", "'0.0'", *["cast(round(99 + o_totalprice / 1000, 5) as string)"] * 2
    ),
    "Charge": _by_priority("'1'", "'1-'", "''", "'2'", "'0'"),
    "Ion_Mode": "case o_orderstatus when 'F' then 'Negative' when 'O' then 'Positive' else 'POSITIVE' end",
    "Adduct": "case o_orderstatus when 'F' then '[M-H]' else '[M+H]' end",
    "Compound_Name": "'Compound ' || "
    + NUMBERED
    + " || "
    + _by_priority("' M+2H/2'", "'F dial M'", "' ?'", "''", "' Unk'"),
    "INCHI": _by_priority(
        f"'\"InChI=1S/ C' || {NUMBERED} || '\"'", "'N/A'", KEY, f"'InChI=1S/C' || {NUMBERED} || 'H'", f"'InChI=1S/C' || {NUMBERED}"
    ),
    "Smiles": _by_priority(f"'C' || {NUMBERED}", f"'InChI=1S/C' || {NUMBERED}", "'n/a'", f"'C' || {NUMBERED}", "''"),
    "InChIKey_inchi": _by_priority(KEY, KEY, "''", KEY, "'N/A'"),
    "InChIKey_smiles": _by_priority("''", "''", "'n/a'", "''", KEY),
    "scan": "cast(o_orderkey as string)",
    "scan_no": "'0'",
}
PEAK_FIELDS = {
    "k": "l_orderkey",
    "mz": "round(l_extendedprice / 100, 4)",
    "intensity": "case when l_linenumber = 7 and l_quantity >= 49 then -l_quantity"
    " when l_quantity = 1 then cast(0 as double) else l_quantity end",
}


def fields(expressions: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in expressions.items()]


def spectrum_id(number: str) -> Column:
    return F.expr(id_text(number))


def n_tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def peaks(spark, sf_dir) -> DataFrame:
    """(k, peaks): the line items of an order as peaks, sorted."""
    # Shuffled as they are: an order's few lines lie apart, so collecting them before the shuffle saves nothing.
    rows = table(spark, sf_dir, "lineitem").selectExpr(*fields(PEAK_FIELDS)).repartition(n_tasks(spark), "k")
    return rows.groupBy("k").agg(F.expr("sort_array(collect_list(struct(mz, intensity)))").alias("peaks"))


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark, sf_dir, name: str, build) -> DataFrame:
    """A derived table, written once per application, as a library is in use.

    Operators that look at their input twice (for hot keys, then for the work)
    then read columns from Parquet instead of deriving the library again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_path(spark, name)
        build().write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def is_stored(spark, sf_dir, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, name) in _stored


def raw(spark, sf_dir) -> DataFrame:
    """The raw library, stored."""
    return stored(spark, sf_dir, "raw", lambda: derive_raw(spark, sf_dir))


def raw_once(spark, sf_dir) -> DataFrame:
    """The raw library for one pass: as stored if it is, else derived on the way, the columns that the pass needs.

    Writing all 37 columns and reading them back takes longer than most passes over them.
    """
    return raw(spark, sf_dir) if is_stored(spark, sf_dir, "raw") else derive_raw(spark, sf_dir)


def derive_raw(spark, sf_dir) -> DataFrame:
    """Raw library records, all text, with the usual faults of such records.

    What follows the join in its stage costs far more than the rows' bytes tell. So the number of
    tasks is named, which keeps them from being merged by bytes, and the peaks are not
    broadcast while they are few: that would leave one task for each block of the orders' file.
    """
    orders = table(spark, sf_dir, "orders").repartition(n_tasks(spark), "o_orderkey")
    joined = orders.join(peaks(spark, sf_dir).hint("merge"), orders["o_orderkey"] == F.col("k"), "left")
    values = {
        **RAW_FIELDS,
        "peaks_json": "to_json(transform(coalesce(peaks, array()), p -> array(p.mz, p.intensity)))",
    }
    return joined.selectExpr(*fields({c: values.get(c, "'N/A'") for c in RAW_COLUMNS}))


def spectra(spark, sf_dir, ion_mode=None) -> DataFrame:
    """The clean library, stored by ion mode."""
    clean = stored(spark, sf_dir, "spectra", lambda: prepare_library(raw_once(spark, sf_dir)))
    return clean if ion_mode is None else clean.filter(F.col("ion_mode") == ion_mode)


def spectra_once(spark, sf_dir) -> DataFrame:
    """``spectra`` for one pass: as stored if it is, else cleaned on the way."""
    return spectra(spark, sf_dir) if is_stored(spark, sf_dir, "spectra") else prepare_library(raw_once(spark, sf_dir))


def _peak_library(spark, sf_dir) -> DataFrame:
    return prepare_library(raw_once(spark, sf_dir)).drop("metadata")


def _of_mode(clean: DataFrame, ion_mode) -> DataFrame:
    return clean if ion_mode is None else clean.filter(F.col("ion_mode") == ion_mode)


def peak_spectra(spark, sf_dir, ion_mode=None) -> DataFrame:
    """The clean library without its records' metadata, which neither words nor bins need; stored by itself if the whole isn't."""
    if is_stored(spark, sf_dir, "spectra"):
        return spectra(spark, sf_dir, ion_mode).drop("metadata")
    return _of_mode(stored(spark, sf_dir, "peak-spectra", lambda: _peak_library(spark, sf_dir)), ion_mode)


def peak_spectra_once(spark, sf_dir, ion_mode=None) -> DataFrame:
    """``peak_spectra`` for one pass: as stored if it is, else cleaned on the way."""
    if is_stored(spark, sf_dir, "spectra") or is_stored(spark, sf_dir, "peak-spectra"):
        return peak_spectra(spark, sf_dir, ion_mode)
    return _of_mode(_peak_library(spark, sf_dir), ion_mode)


def processed(spark, sf_dir) -> DataFrame:
    """The library prepared for binning, for one pass."""
    return peak_spectra_once(spark, sf_dir).transform(process_spectra)


def binned(spark, sf_dir, n_bins) -> DataFrame:
    """The binned library, stored."""
    keep = ["spectrum_id", "ion_mode", "bins"]
    return stored(
        spark, sf_dir, f"binned-{n_bins}", lambda: processed(spark, sf_dir).transform(bin_peaks, n_bins).select(*keep)
    )


def documents(spark, sf_dir, ion_mode=None) -> DataFrame:
    """The documents of the clean library, stored; words of two decimals."""
    docs = stored(
        spark,
        sf_dir,
        "documents",
        lambda: create_documents(peak_spectra_once(spark, sf_dir), 2),
    )
    return docs if ion_mode is None else docs.filter(F.col("ion_mode") == ion_mode)


def library(spark, sf_dir) -> DataFrame:
    """(spectrum_id, precursor_mz, ion_mode) of every order."""
    return table(spark, sf_dir, "orders").selectExpr(*fields(LIBRARY_FIELDS))


def remeasured(spark, sf_dir) -> DataFrame:
    """Line items as later measurements of the record they belong to; ids repeat."""
    return table(spark, sf_dir, "lineitem").select(
        spectrum_id("l_orderkey").alias("spectrum_id"),
        F.round(100 + F.col("l_extendedprice") / 1000, 5).alias("precursor_mz"),
        F.lit("negative").alias("ion_mode"),
        F.col("l_shipdate").alias("measured_at"),
        F.col("l_linenumber").alias("pos"),
    )


def listed_ids(spark, sf_dir) -> DataFrame:
    """Ids of the line items, repeated as they are."""
    return table(spark, sf_dir, "lineitem").select(spectrum_id("l_orderkey").alias("spectrum_id"))


def embedding_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(spectrum_id("vec_id").alias("spectrum_id"))


def embeddings(spark, sf_dir) -> DataFrame:
    """The given vectors with their record's m/z and ion mode, stored as an index is."""
    return stored(spark, sf_dir, "embeddings", lambda: derive_embeddings(spark, sf_dir))


def derive_embeddings(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        spectrum_id("vec_id").alias("spectrum_id"),
        "label",
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    records, ids = library(spark, sf_dir), vectors.select("spectrum_id")
    if ids.limit(FEW_IDS + 1).count() <= FEW_IDS:
        # The orders that no vector belongs to aren't shuffled.
        records = records.join(F.broadcast(ids), "spectrum_id", "left_semi")
    return vectors.join(records, "spectrum_id")


def with_zero_vectors(vectors: DataFrame) -> DataFrame:
    """Vectors of label 0 replaced by zero vectors."""
    zero = F.transform("vector", lambda v: v * 0.0)
    return vectors.withColumn("vector", F.when(F.col("label") == 0, zero).otherwise(F.col("vector")))


def query_side(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("spectrum_id").alias("query_id"),
        F.col("precursor_mz").alias("query_mz"),
        F.col("vector").alias("query_vector"),
        "ion_mode",
        *[F.col("label").alias("request_id") for c in vectors.columns if c == "label"],
    )


def ref_side(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("spectrum_id").alias("ref_id"),
        F.col("precursor_mz").alias("ref_mz"),
        F.col("vector").alias("ref_vector"),
        "ion_mode",
    )


def word_vectors(vocabulary: DataFrame) -> DataFrame:
    """A fixed vector per word, from the digits of its md5."""
    digest = F.md5("word")
    return vocabulary.select(
        "word",
        F.array(
            *[
                F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("double") / 255 - 0.5
                for i in range(WORD_DIM)
            ]
        ).alias("vector"),
    )


def supplier_features(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("key"), F.col("l_partkey").alias("feature")
    )


def part_structures(spark, sf_dir) -> DataFrame:
    """Parts as spectra of a structure: brand and type."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("PT"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("spectrum_id"),
        F.substring(F.md5(F.concat("p_brand", "p_type")), 1, 14).alias("key"),
        F.concat(F.lit("InChI=1S/"), F.col("p_size").cast("string")).alias("inchi"),
        F.col("p_partkey"),
    )


def part_features(spark, sf_dir) -> DataFrame:
    """Features of a part structure: the suppliers of its parts."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("feature")
    )
    return lines.join(part_structures(spark, sf_dir), "p_partkey").select("key", "feature")


def requests(spark, sf_dir) -> DataFrame:
    """Search requests as they came in, stored."""
    return stored(spark, sf_dir, "requests", lambda: derive_requests(spark, sf_dir))


def derive_requests(spark, sf_dir) -> DataFrame:
    """(request_id, payload): one unusable query, one without and one with an id."""
    records = raw_once(spark, sf_dir)
    mz, peaks_json = F.col("Precursor_MZ"), F.col("peaks_json")

    def query(own_id, peak_text):
        return F.struct(own_id.alias("spectrum_id"), peak_text.alias("peaks_json"), mz.alias("Precursor_MZ"))

    payload = F.struct(
        F.struct(F.lit(2).alias("n_best_spectra")).alias("parameters"),
        F.array(
            query(F.lit("broken"), F.lit("[[80.06, 15")),
            query(F.lit(""), peaks_json),
            query(F.col("spectrum_id"), peaks_json),
        ).alias("data"),
    )
    return records.select(F.col("spectrum_id").alias("request_id"), F.to_json(payload).alias("payload"))
