"""Readers of spectral libraries and of search requests."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.functions import peaks as P
from specloom.functions.text import number
from specloom.operators.ranking import query_label
from specloom.schema import RAW_KEYS, RENAMED_KEYS, SPECTRUM_SCHEMA, require_columns
from specloom.sources.json_arrays import record_texts


RECORD = "map<string,string>"


def read_library_json(spark: SparkSession, paths, check_keys: bool = True, layout: str = "lines") -> DataFrame:
    """Raw records from JSON text, the values kept as the text they have in the file.

    ``layout="lines"``: one record, or one array of records, per line, read in
    one pass. ``layout="any"``: also arrays over many lines, several to a
    file, as the published library has them; read in byte ranges, in three passes
    over the text. Anything else is refused rather than read in part, and
    so is a record lacking one of the 37 keys, unless ``check_keys`` is off.
    """
    if layout == "any":
        parsed = record_texts(spark, paths).select(F.array(F.from_json("text", RECORD)).alias("records"), F.col("text").alias("line"))
    elif layout == "lines":
        text = F.trim(F.regexp_replace("value", r"^\x{FEFF}", ""))
        parsed = spark.read.text(paths).filter(F.length(text) > 0).select(
            F.when(F.startswith(text, F.lit("[")), F.from_json(text, f"array<{RECORD}>"))
            .otherwise(F.array(F.from_json(text, RECORD)))
            .alias("records"),
            text.alias("line"),
        )
    else:
        raise ValueError('layout must be "lines" or "any"')
    whole = F.col("records").isNotNull() & ~F.exists("records", lambda r: r.isNull())
    hint = "not one JSON value per line: " if layout == "lines" else "not a record: "
    refused = F.raise_error(F.concat(F.lit(hint), F.substring("line", 1, 80)))
    records = parsed.select(F.explode(F.when(whole, F.col("records")).otherwise(refused)).alias("r"))

    def value(key):
        found = F.try_element_at("r", F.lit(key))
        if not check_keys:
            return found
        absent = F.raise_error(F.lit(f"a record lacks the key {key}"))
        return F.when(F.map_contains_key("r", F.lit(key)), found).otherwise(absent)

    return records.select(*[value(key).alias(RENAMED_KEYS.get(key, key)) for key in RAW_KEYS])


def write_library_json(raw: DataFrame, path: str, layout: str = "lines") -> None:
    """Raw records as JSON text under the file's own key names.

    ``layout="lines"``: one record per line. ``layout="array"``: in each file one
    array over many lines, with a line for every key.
    """
    spark_names = {new: old for old, new in RENAMED_KEYS.items()}
    pairs = [
        part
        for column in raw.columns
        for part in (F.lit(spark_names.get(column, column)), F.col(column))
    ]
    record = F.create_map(*pairs)
    if layout == "lines":
        raw.select(F.to_json(record).alias("value")).write.text(path)
        return
    lines = raw.select(F.to_json(record, {"pretty": "true"}).alias("value"))
    # Rows and the brackets around them are written as they come, so each file is an array of its own.
    lines.mapInArrow(_as_array, "value string").write.text(path)


def _as_array(batches):
    """The texts of a partition with brackets around them and commas between."""
    before = "["
    for batch in batches:
        if batch.num_rows:
            marks = pa.array([before, *[","] * (batch.num_rows - 1)])
            before = ","
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column("value"), "")], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], ["value"])


# Lines that open and close a spectrum in MGF text.
MGF_BEGIN = "BEGIN IONS"
MGF_END = "END IONS"


def read_library_mgf(spark: SparkSession, paths) -> DataFrame:
    """Spectra from MGF text.

    The end mark serves as record separator, so Spark splits large files
    between blocks. A value may hold further ``=``; only the first one counts.
    """
    blocks = spark.read.option("lineSep", MGF_END).text(paths)
    body = F.element_at(F.split("value", MGF_BEGIN), -1)
    lines = F.transform(F.split(F.regexp_replace(body, "\r", ""), "\n"), lambda x: F.trim(x))
    numbers = r"^[0-9.][0-9.eE+-]*[ \t]+[0-9.eE+-]+"

    def entry(line):
        at = F.instr(line, "=")
        return F.struct(
            F.lower(F.call_function("substring", line, F.lit(1), at - 1)).alias("key"),
            F.call_function("substring", line, at + 1).alias("value"),
        )

    def peak(line):
        parts = F.split(line, r"[ \t]+")
        return F.struct(
            number(F.get(parts, F.lit(0))).alias("mz"), number(F.get(parts, F.lit(1))).alias("intensity")
        )

    def last_of_each_key(entries):
        """A repeated key keeps its last value."""
        place = lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))
        placed = F.transform(entries, place)
        later = lambda e: F.exists(F.slice(entries, e["i"] + 2, F.size(entries)), lambda x: x["key"] == e["key"])
        kept = F.filter(placed, lambda e: ~later(e))
        return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))

    parsed = (
        blocks.filter(F.contains("value", F.lit(MGF_BEGIN)))
        .select(lines.alias("lines"))
        .select(
            "lines", F.transform(F.filter("lines", lambda x: x.rlike("^[A-Za-z_][^=]*=")), entry).alias("entries")
        )
        .select(
            last_of_each_key(F.col("entries")).alias("metadata"),
            F.sort_array(F.transform(F.filter("lines", lambda x: x.rlike(numbers)), peak)).alias("peaks"),
        )
    )

    def field(name):
        return F.try_element_at("metadata", F.lit(name))

    spectra = parsed.select(
        field("spectrum_id").alias("spectrum_id"),
        number(F.coalesce(field("precursor_mz"), F.get(F.split(field("pepmass"), r"\s+"), F.lit(0)))).alias(
            "precursor_mz"
        ),
        field("charge").alias("charge"),
        field("ionmode").alias("ion_mode"),
        field("exactmass").alias("exact_mass"),
        number(field("parent_mass")).alias("parent_mass"),
        field("adduct").alias("adduct"),
        F.coalesce(field("compound_name"), field("name")).alias("compound_name"),
        field("smiles").alias("smiles"),
        field("inchi").alias("inchi"),
        field("inchikey").alias("inchikey"),
        "peaks",
        "metadata",
    )
    return spectra.select(*SPECTRUM_SCHEMA.fieldNames())


def write_library_mgf(spectra: DataFrame, path: str) -> None:
    """Spectra as MGF text, one block each."""
    fields = {
        "SPECTRUM_ID": F.col("spectrum_id"),
        "PRECURSOR_MZ": F.col("precursor_mz").cast("string"),
        "CHARGE": F.col("charge").cast("string"),
        "IONMODE": F.col("ion_mode"),
        "PARENT_MASS": F.col("parent_mass").cast("string"),
        "ADDUCT": F.col("adduct"),
        "COMPOUND_NAME": F.col("compound_name"),
        "SMILES": F.col("smiles"),
        "INCHI": F.col("inchi"),
        "INCHIKEY": F.col("inchikey"),
    }
    head = [
        F.when(value.isNotNull(), F.concat(F.lit(f"{name}="), value)) for name, value in fields.items()
    ]
    peaks = F.array_join(
        F.transform("peaks", lambda p: F.concat_ws(" ", p["mz"].cast("string"), p["intensity"].cast("string"))),
        "\n",
    )
    block = F.concat_ws("\n", F.lit(MGF_BEGIN), *head, peaks, F.lit(MGF_END))
    spectra.select(block.alias("value")).write.text(path)


def library_ids(raw: DataFrame) -> DataFrame:
    """The library's own ids, ``SpectrumID``, as ``read_by_ids`` takes them."""
    return raw.select(F.col("SpectrumID").alias("spectrum_id"))


def read_by_ids(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose ``SpectrumID`` is among ``ids`` (a ``spectrum_id`` column)."""
    wanted = ids.select(F.col("spectrum_id").alias("SpectrumID")).distinct()
    return raw.join(wanted, "SpectrumID", "left_semi").select(*raw.columns)


REQUEST_SCHEMA = (
    "struct<parameters: struct<n_best_spectra: int, include_metadata: array<string>>,"
    " data: array<struct<spectrum_id: string, peaks_json: string, Precursor_MZ: string>>>"
)


def parse_query_payload(requests: DataFrame) -> DataFrame:
    """(request_id, payload JSON) to one row per query spectrum.

    A query keeps its position in the request, also when others before it are
    unusable; its label is its own id or ``spectrum-<position>``. Absent
    parameters are NULL.
    """
    require_columns(requests, ["request_id", "payload"])
    # Exploded from an array of one, so that the text is parsed once for all fields.
    once = F.explode(F.array(F.from_json("payload", REQUEST_SCHEMA)))
    parsed = requests.select("request_id", once.alias("p"))
    return parsed.select(
        "request_id",
        F.col("p.parameters.n_best_spectra").alias("n_best_spectra"),
        F.col("p.parameters.include_metadata").alias("include_metadata"),
        F.posexplode("p.data").alias("query_pos", "d"),
    ).select(
        "request_id",
        "query_pos",
        query_label(F.col("d.spectrum_id"), F.col("query_pos")).alias("query_label"),
        "n_best_spectra",
        "include_metadata",
        number(F.col("d.Precursor_MZ")).alias("precursor_mz"),
        F.explode(P.usable_peaks(F.col("d.peaks_json"))).alias("peaks"),
    )

