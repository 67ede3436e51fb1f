"""JSON records in any layout, cut into byte ranges at any place."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest

from checks import tables
from checks.queries import REGISTRY
from specloom.schema import RAW_KEYS
from specloom.sources import json_arrays, library
from specloom.sources.json_arrays import record_texts
from tests.helpers import raw


@pytest.fixture
def small_ranges(spark):
    """Ranges of some bytes, far smaller than a record."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}

    def set_to(n):
        names["spark.sql.files.maxPartitionBytes"] = str(n)
        for name, value in names.items():
            spark.conf.set(name, value)

    yield set_to
    for name in names:
        spark.conf.unset(name)


def nasty(draw: random.Random, k: int):
    text = "".join(draw.choice(["}", "{", '"', "\\", "\n", "[", "]", ",", "é", "x", "😀", '\\"', "}{", '"}', "\\\\"]) for _ in range(draw.randrange(30)))
    return {"id": k, text: [text, {"deep": {text: 1}}, [{"a": text}] * draw.randrange(3)], "z": draw.choice([None, 1.5, {}, {"e": {}}])}


def read(spark, path):
    return sorted((json.loads(r.text) for r in record_texts(spark, str(path)).collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("size", [37, 10**6])
@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_in_ranges_equal_the_records(spark, tmp_path, small_ranges, size, indent):
    draw = random.Random(size)
    records = [nasty(draw, k) for k in range(14 if size > 100 else 9)]
    n = len(records)
    one, two, three = records[: n - 8], records[n - 8 : n - 7], records[n - 7 : n - 2]
    whole = [json.dumps(x, indent=indent, ensure_ascii=k % 2 == 0) for k, x in enumerate((one, [], two, three))]
    (tmp_path / "a.json").write_text("\n\n" + "\n".join(whole) + "\n \n", "utf-8")  # several arrays in a row
    (tmp_path / "b.json").write_bytes(b"\xef\xbb\xbf" + "\n".join(json.dumps(r) for r in records[n - 2 : n - 1]).encode())  # ends with a brace
    (tmp_path / "c.json").write_text(json.dumps(records[n - 1]) + "\n")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text(" [ ]\n")
    small_ranges(size)
    assert read(spark, tmp_path) == records


def test_unfinished_files_and_other_values_are_refused(spark, tmp_path):
    for k, text in enumerate(['[{"id": 1}, {"id": 2', '[{"id": 1}, {"id": "}', '[{"id": 1}]}', '{"id": {"a": 1}', "[1", '[{"id": 1}, "x"'.replace('"x"', '"x')]):
        path = tmp_path / f"{k}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="ends within a record|not a record"):
            record_texts(spark, str(path)).collect()
    for k, text in enumerate(['[1, {"id": 1}]', '["a{", {"id": 1}]', 'null {"id": 1}']):
        path = tmp_path / f"other{k}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="not a record"):
            record_texts(spark, str(path)).collect()


def test_groups_of_files(spark, tmp_path, small_ranges, monkeypatch):
    from specloom.sources import json_arrays

    monkeypatch.setattr(json_arrays, "MAX_RANGES", 3)
    records = [{"id": k, "t": "}" * k} for k in range(30)]
    for k in range(6):
        (tmp_path / f"{k}.json").write_text(json.dumps(records[5 * k : 5 * k + 5], indent=2))
    small_ranges(60)
    assert read(spark, tmp_path) == records


def test_library_as_arrays_over_many_lines(spark, tmp_path, small_ranges):
    rows = raw(spark, *[{"Compound_Name": f'a "}}{{" \\ {i}', "peaks_json": f"[[{i}.5, 1]]", "Smiles": None if i == 3 else "C"} for i in range(25)])
    library.write_library_json(rows.repartition(3), str(tmp_path / "out"), layout="array")
    small_ranges(5000)
    again = library.read_library_json(spark, str(tmp_path / "out"), check_keys=False, layout="any")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.select(*again.columns).collect()))
    some = {k: "v" for k in RAW_KEYS[1:]}
    (tmp_path / "less.json").write_text(json.dumps([some], indent=1))
    with pytest.raises(Exception, match=f"lacks the key {RAW_KEYS[0]}"):
        library.read_library_json(spark, str(tmp_path / "less.json"), layout="any").collect()
    with pytest.raises(ValueError, match="layout"):
        library.read_library_json(spark, "x", layout="array")


def test_backslashes_before_quotes_are_counted_back_to_the_row_only(spark):
    """Against a scan of every byte; a long run of backslashes costs no array of its own."""
    import tracemalloc

    rng = np.random.default_rng(4)
    rows = ["".join(rng.choice(list('"\\{a'), rng.integers(0, 9))) for _ in range(400)] + ["\\" * 7 + '"{', '"', "", '\\"{']
    odd, opened = json_arrays._scanned(pa.array(rows))
    for row, o, (outside, inside) in zip(rows, odd, opened):
        quotes, braces, run = 0, [0, 0], 0
        for c in row:
            quotes += c == '"' and run % 2 == 0
            braces[quotes % 2] += c == "{"
            run = run + 1 if c == "\\" else 0
        assert (o, outside, inside) == (quotes % 2, *braces)
    text = pa.array(['{"a": "' + "x" * 1000 + '\\"", '] * 4000)
    tracemalloc.start()
    json_arrays._scanned(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * text.nbytes


def test_the_arrays_are_written_without_a_stored_library(spark, monkeypatch):
    monkeypatch.setattr(tables, "_stored", {})
    found = REGISTRY["read_library_json_arrays"](spark, "/root/testdata/sf0.001")
    assert found.count() == tables.table(spark, "/root/testdata/sf0.001", "orders").count()
    assert not tables._stored
