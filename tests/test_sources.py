import json

import pytest
from pyspark.sql import functions as F

from specloom.operators import cleaning
from specloom.schema import RAW_COLUMNS, RAW_KEYS
from specloom.sources import datasets, library, store
from specloom.streaming.ingest import ingest_raw_stream
from tests.helpers import column, pairs, raw, spectra


def record(**values):
    return {**dict.fromkeys(RAW_KEYS, "N/A"), **values}


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_json_lines_and_arrays_per_line(spark, tmp_path):
    one, two = record(spectrum_id="a", scan="1", Scan="2"), record(spectrum_id="b", Precursor_MZ=800.5, extra="x")
    path = write(tmp_path / "lib.json", json.dumps(one), json.dumps([two, record(spectrum_id="c")]), "")
    df = library.read_library_json(spark, path)
    assert df.columns == RAW_COLUMNS
    assert column(df, "spectrum_id") == ["a", "b", "c"]
    first, second, _ = df.orderBy("spectrum_id").collect()
    assert (first["scan"], first["scan_no"]) == ("1", "2")
    assert second["Precursor_MZ"] == "800.5"
    assert column(library.library_ids(df.withColumn("SpectrumID", F.upper("spectrum_id"))), "spectrum_id") == ["A", "B", "C"]


def test_json_refuses_what_it_cannot_read_whole(spark, tmp_path):
    missing = record(spectrum_id="a")
    del missing["url"]
    path = write(tmp_path / "missing.json", json.dumps(missing))
    with pytest.raises(Exception, match="lacks the key url"):
        library.read_library_json(spark, path).collect()
    assert library.read_library_json(spark, path, check_keys=False).count() == 1
    spread = write(tmp_path / "spread.json", json.dumps([record()], indent=1))
    with pytest.raises(Exception, match="not one JSON value per line"):
        library.read_library_json(spark, spread).collect()


def test_json_round_trip(spark, tmp_path):
    df = raw(spark, {"scan": "1", "scan_no": "2", "peaks_json": "[[1.5, 2.0]]"}, {"Smiles": 'C"\\ü'})
    library.write_library_json(df, str(tmp_path / "out"))
    again = library.read_library_json(spark, str(tmp_path / "out"))
    assert pairs(again, *RAW_COLUMNS) == pairs(df, *RAW_COLUMNS)


def test_read_by_ids(spark):
    df = raw(spark, {"SpectrumID": "x"}, {"SpectrumID": "y"})
    ids = spark.createDataFrame([("y",), ("y",), ("unknown",)], "spectrum_id string")
    assert column(library.read_by_ids(df, ids), "SpectrumID") == ["y"]


MGF = """BEGIN IONS
PEPMASS=183.057
CHARGE=1-
IONMODE=negative
SMILES=CC=O
COMPOUND_NAME=a=b
SPECTRUM_ID=ONE
PRECURSOR_MZ=183.057
PARENT_MASS=184.06427645199076
INCHIKEY=
100.5 0.25
90.25\t1.0
1e2 3.5e-1
END IONS

BEGIN IONS
PEPMASS=200.5 1000
SPECTRUM_ID=TWO
CHARGE=2+
50 1
END IONS
"""


def test_mgf_text(spark, tmp_path):
    path = write(tmp_path / "lib.mgf", MGF.replace("\n", "\r\n"))
    df = library.read_library_mgf(spark, path)
    one, two = df.orderBy("spectrum_id").collect()
    assert (one["spectrum_id"], one["smiles"], one["compound_name"]) == ("ONE", "CC=O", "a=b")
    assert [tuple(p) for p in one["peaks"]] == [(90.25, 1.0), (100.0, 0.35), (100.5, 0.25)]
    assert one["metadata"]["inchikey"] == ""
    assert (two["spectrum_id"], two["precursor_mz"], len(two["peaks"])) == ("TWO", 200.5, 1)
    derived = df.transform(cleaning.normalise_metadata).transform(cleaning.derive_parent_mass)
    assert column(derived, "parent_mass")[0] == pytest.approx(one["parent_mass"], abs=1e-6)


def test_payload_keeps_positions(spark):
    payload = {
        "parameters": {"n_best_spectra": 2, "include_metadata": ["compound_name"]},
        "data": [
            {"peaks_json": "[[80.060677, 157.0], [337.508301, 230.0]]", "Precursor_MZ": "353.233"},
            {"peaks_json": "[[80.06, 15", "Precursor_MZ": "1"},
            {"peaks_json": [[1.0, 2.0]], "Precursor_MZ": 800},
            {"spectrum_id": "mine", "peaks_json": "[[1, 2]]", "Precursor_MZ": "800.00"},
        ],
    }
    df = spark.createDataFrame([("r", json.dumps(payload)), ("empty", '{"data": []}')], "request_id string, payload string")
    rows = library.parse_query_payload(df).orderBy("query_pos").collect()
    assert [(r["query_pos"], r["query_label"], r["precursor_mz"]) for r in rows] == [
        (0, "spectrum-0", 353.233),
        (2, "spectrum-2", 800.0),
        (3, "mine", 800.0),
    ]
    assert rows[0]["n_best_spectra"] == 2 and rows[0]["include_metadata"] == ["compound_name"]
    bare = spark.createDataFrame([("r", json.dumps({"data": payload["data"]}))], "request_id string, payload string")
    assert library.parse_query_payload(bare).first()["n_best_spectra"] is None


def test_many_paths(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("one", "two")]
    for i, path in enumerate(paths):
        spectra(spark, {"spectrum_id": f"p{i}"}).write.parquet(path)
    df = datasets.read_many_paths(spark, paths)
    assert column(df, "spectrum_id") == ["p0", "p1"]
    assert "/two/" in column(df, "source_path")[1]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert datasets.latest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        datasets.read_version(spark, path)
    assert datasets.write_version(spark.range(3), path) == 0
    current = datasets.read_version(spark, path)
    assert datasets.write_version(current.union(spark.range(10, 12)), path) == 1
    assert datasets.read_version(spark, path).count() == 5
    assert datasets.read_version(spark, path, 0).count() == 3
    (tmp_path / "table" / "v000002").mkdir()
    assert datasets.latest_version(spark, path) == 1


def test_partitions_are_replaced_and_dropped_alone(spark, tmp_path):
    path = str(tmp_path / "emb")
    schema = "spectrum_id string, vector array<double>, project string, ion_mode string"
    both = spark.createDataFrame([("a", [1.0], "p", "positive"), ("b", [2.0], "p", "negative")], schema)
    datasets.write_dataset(both, path, ("project", "ion_mode"))
    new = spark.createDataFrame([("c", [3.0], "p", "positive")], schema)
    datasets.replace_partitions(new, path, ("project", "ion_mode"))
    assert pairs(datasets.read_dataset(spark, path), "spectrum_id", "ion_mode") == [("b", "negative"), ("c", "positive")]
    for _ in range(2):
        datasets.drop_partition(spark, path, project="p", ion_mode="positive")
    assert column(datasets.read_dataset(spark, path), "spectrum_id") == ["b"]


def rows(spark, *values):
    return spark.createDataFrame(list(values), "spectrum_id string, mz double, pos int")


def test_upsert_last_write_wins_and_repeats_safely(spark):
    old = rows(spark, ("a", 1.0, 0), ("b", 2.0, 0))
    batch = rows(spark, ("b", 5.0, 1), ("b", 6.0, 2), ("c", 7.0, 0))
    once = store.upsert_spectra(old, batch, ["pos"])
    assert pairs(once, "spectrum_id", "mz") == [("a", 1.0), ("b", 6.0), ("c", 7.0)]
    assert pairs(store.upsert_spectra(once, batch, ["pos"]), "spectrum_id", "mz") == pairs(once, "spectrum_id", "mz")


def test_upsert_in_partitions(spark):
    schema = "spectrum_id string, v int, ion_mode string, pos int"
    table = spark.createDataFrame([("a", 1, "positive", 0), ("a", 2, "negative", 0)], schema)
    batch = spark.createDataFrame([("a", 9, "positive", 1), ("b", 3, "positive", 1)], schema)
    got = store.write_binned(table.drop("pos"), batch, ["pos"])
    assert pairs(got, "ion_mode", "spectrum_id", "v") == [("negative", "a", 2), ("positive", "a", 9), ("positive", "b", 3)]


def test_caching_writes_only_new_ids(spark):
    stored = rows(spark, ("a", 1.0, 0))
    new, ids = store.cache_new_spectra(rows(spark, ("a", 3.0, 0), ("b", 4.0, 0)), stored)
    assert column(new, "spectrum_id") == ["b"]
    assert column(ids, "spectrum_id") == ["a", "b"]
    assert store.cache_new_spectra(stored, stored)[0].isEmpty()


def test_ids_and_multi_get(spark):
    stored = rows(spark, ("a", 1.0, 0), ("b", 2.0, 0), ("b", 2.0, 1))
    ids = spark.createDataFrame([("b",), ("b",), ("x",), ("x",)], "spectrum_id string")
    assert column(store.stored_ids(stored), "spectrum_id") == ["a", "b"]
    assert column(store.existing_ids(ids, stored), "spectrum_id") == ["b"]
    assert column(store.missing_ids(ids, stored), "spectrum_id") == ["x", "x"]
    assert column(store.fetch_spectra(stored, ids), "spectrum_id") == ["b", "b"]
    assert store.fetch_spectra(stored).count() == 3
    assert store.fetch_spectra(stored, ids.limit(0)).count() == 0
    assert column(store.delete_spectra(stored, ids), "spectrum_id") == ["a"]


def test_stream_adds_each_spectrum_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "library")
    source.mkdir()
    schema = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)

    def arrive(name, *ids):
        records = [{"spectrum_id": i, "Charge": "1", "Ion_Mode": "Positive", "Precursor_MZ": "5", "peaks_json": "[[1, 2]]"} for i in ids]
        raw(spark, *records).coalesce(1).write.parquet(str(source / name))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(source / "*"))
        ingest_raw_stream(spark, stream, target, str(tmp_path / "checkpoint")).awaitTermination()
        return column(spark.read.parquet(target), "spectrum_id")

    arrive("one", "a", "b", "b")
    assert run() == ["a", "b"]
    arrive("two", "b", "c")
    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
