"""The keyed table: only touched buckets, committed versions, filters of ids."""

import pytest
from pyspark.sql import functions as F

from specloom.sources import keyed
from specloom.sources.keyed import KeyedTable

SCHEMA = "spectrum_id string, precursor_mz double, ion_mode string, pos int"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def content(df):
    return sorted(map(tuple, df.select("spectrum_id", "precursor_mz", "ion_mode", "pos").collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable.create(spark, f"file://{tmp_path}/t", rows(spark).schema, ("ion_mode",), n_buckets=8)


def test_batches_replace_delete_and_compact_as_one_table_would(spark, table):
    first = [(f"s{i:02d}", float(i), "positive" if i % 2 else "neg/ative", 0) for i in range(40)]
    table.upsert(rows(spark, *first), ["pos"])
    again = [("s01", 100.0, "positive", 1), ("s01", 101.0, "positive", 2), ("new", 5.0, "positive", 0), (None, 6.0, "positive", 0)]
    table.upsert(rows(spark, *again), ["pos"])
    table.delete(rows(spark, ("s03", 0.0, "positive", 0), ("s04", 0.0, "positive", 0), ("none", 0.0, "positive", 0)))
    want = {r[0]: r for r in first} | {"s01": again[1], "new": again[2], None: again[3]}
    del want["s03"]
    want = sorted(want.values(), key=str)
    assert content(table.read()) == want
    before = table.manifest()
    table.compact(least_deltas=1)
    assert content(table.read()) == want and all(len(p) == 1 for p in table.manifest().parts.values())
    assert content(table.read(before.number)) == want
    assert content(table.read(ion_mode="neg/ative")) == [r for r in want if r[2] == "neg/ative"]
    table.upsert(rows(spark, ("s03", 9.0, "positive", 0)), ["pos"])
    assert content(table.read()) == sorted([*want, ("s03", 9.0, "positive", 0)], key=str)
    table.vacuum()
    assert content(table.read()) == sorted([*want, ("s03", 9.0, "positive", 0)], key=str) and len(table.versions()) == 1
    ids = spark.createDataFrame([("s01",), ("s08",), ("s08",), ("unknown",)], "spectrum_id string")
    assert [r[0] for r in content(table.fetch(ids))] == ["s01", "s08"]
    assert table.upsert(rows(spark), ["pos"]) == table.manifest().number


def test_a_batch_touches_its_buckets_only(spark, table):
    table.upsert(rows(spark, *[(f"s{i:03d}", float(i), "positive", 0) for i in range(400)]), ["pos"])
    old = table.manifest()
    table.upsert(rows(spark, ("s005", 1.0, "positive", 1)), ["pos"])
    new = table.manifest()
    changed = [b for b in new.parts if new.parts[b] != old.parts[b]]
    assert len(changed) == 1 and new.parts[changed[0]][:1] == old.parts[changed[0]]
    assert table._names(f"{table.path}/data/{new.parts[changed[0]][1][1]}/ion_mode=positive") == [changed[0].split("/")[1]]
    one = spark.createDataFrame([("s005",)], "spectrum_id string")
    files = {f.split("/_bucket=")[1].split("/")[0] for f in table.fetch(one).inputFiles()}
    assert files == {changed[0].split("=")[-1]}
    table.compact(least_deltas=1)
    assert [b for b in new.parts if table.manifest().parts[b] != new.parts[b]] == changed


def test_a_crash_between_two_steps_leaves_the_old_rows(spark, table, monkeypatch):
    old = [("a", 1.0, "positive", 0), ("b", 2.0, "negative", 0)]
    table.upsert(rows(spark, *old), ["pos"])

    def fail(self, new):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", fail)
        for change in (
            lambda: table.upsert(rows(spark, ("a", 9.0, "positive", 1)), ["pos"]),
            lambda: table.replace(rows(spark, ("c", 9.0, "positive", 1)), ion_mode="positive"),
            lambda: table.delete(rows(spark, *old)),
            lambda: table.compact(least_deltas=0),
        ):
            with pytest.raises(OSError):
                change()
            assert content(table.read()) == old
    broken = rows(spark, ("c", 9.0, "positive", 1)).withColumn("pos", F.raise_error(F.lit("no row")).cast("int"))
    with pytest.raises(Exception, match="no row"):
        table.replace(broken, ion_mode="positive")
    assert content(table.read()) == old
    table.vacuum()
    assert content(table.read()) == old


def test_replace_swaps_one_partition_at_once(spark, table):
    table.upsert(rows(spark, ("a", 1.0, "positive", 0), ("b", 2.0, "negative", 0)), ["pos"])
    before = table.read()
    table.replace(rows(spark, ("c", 3.0, "positive", 0), ("d", 3.0, "negative", 0)), ion_mode="positive")
    assert content(table.read()) == [("b", 2.0, "negative", 0), ("c", 3.0, "positive", 0)]
    assert content(before) == [("a", 1.0, "positive", 0), ("b", 2.0, "negative", 0)]
    table.replace(rows(spark), ion_mode="positive")
    assert content(table.read()) == [("b", 2.0, "negative", 0)]
    with pytest.raises(ValueError, match="partitioned by"):
        table.replace(rows(spark), other=1)


def test_two_writers_of_one_version(spark, table):
    old = table.manifest()
    table.upsert(rows(spark, ("a", 1.0, "positive", 0)), ["pos"])
    with pytest.raises(RuntimeError, match="another writer"):
        table._add(rows(spark, ("b", 1.0, "positive", 0)), old, deleted=False)
    assert [r[0] for r in content(table.read())] == ["a"]


@pytest.mark.parametrize("bits", [1, 12])
def test_only_new_equals_the_anti_join_at_any_rate_of_false_hits(spark, table, monkeypatch, bits):
    monkeypatch.setattr(keyed, "ID_BITS", bits)
    stored = [(f"s{i:04d}", 0.0, "positive", 0) for i in range(0, 3000, 2)]
    table.upsert(rows(spark, *stored), ["pos"])
    batch = rows(spark, *[(f"s{i:04d}", 1.0, "positive", 0) for i in range(1000)], ("s0000", 1.0, "negative", 0), ("s0001", 2.0, "positive", 0))
    want = sorted([(f"s{i:04d}", 1.0, "positive", 0) for i in range(1, 1000, 2)] + [("s0000", 1.0, "negative", 0), ("s0001", 2.0, "positive", 0)])
    assert content(table.only_new(batch)) == want
    manifest = table.manifest()
    keys = table._bucketed(rows(spark, *[(f"x{i}", 0.0, "positive", 0) for i in range(500)]).select("ion_mode", "spectrum_id"), manifest.n_buckets)
    found = table._maybe_stored(keys, manifest).count()
    assert found < 25 if bits == 12 else found > 25
    table.append_new(batch, ["precursor_mz"])
    assert table.read().count() == 1500 + 501


def test_a_batch_of_new_ids_does_not_read_the_table(spark, table):
    table.upsert(rows(spark, *[(f"s{i}", 0.0, "positive", 0) for i in range(50)]), ["pos"])
    fresh = rows(spark, *[(f"t{i}", 0.0, "positive", 0) for i in range(20)])
    manifest = table.manifest()
    if table._maybe_stored(table._bucketed(fresh.select("ion_mode", "spectrum_id"), manifest.n_buckets), manifest).isEmpty():
        assert table.only_new(fresh) is fresh


def test_without_filters_every_id_is_looked_up(spark, tmp_path):
    plain = KeyedTable.create(spark, f"file://{tmp_path}/plain", rows(spark).schema, ("ion_mode",), 4, filters=False)
    plain.upsert(rows(spark, *[(f"s{i}", 0.0, "positive", 0) for i in range(30)]), ["pos"])
    plain.replace(rows(spark, *[(f"s{i}", 1.0, "positive", 0) for i in range(20)], ("s0", 1.0, "positive", 0)), ion_mode="positive")
    assert plain.read().count() == 20
    batch = rows(spark, *[(f"s{i}", 2.0, "positive", 0) for i in range(10, 25)])
    assert [r[0] for r in content(plain.only_new(batch))] == [f"s{i}" for i in range(20, 25)]
    assert plain._names(f"{plain.path}/filters") == []


def test_a_bucket_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "_IDS_AT_ONCE", 7)
    table = KeyedTable.create(spark, f"file://{tmp_path}/one", rows(spark).schema, ("ion_mode",), n_buckets=1)
    given = [(f"s{i % 300:03d}", float(i), "positive", i) for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.upsert(rows(spark, *given), ["pos"])
        upserted = len(list((tmp_path / "one" / "data").glob("*/*/*/*.parquet")))
        table.replace(rows(spark, *given[300:], *given[300:]), ion_mode="positive")
        both = len(list((tmp_path / "one" / "data").glob("*/*/*/*.parquet")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert upserted > 1 and both - upserted > 1
    assert content(table.read()) == sorted(given[300:], key=str)
    batch = rows(spark, *given[:300], ("new", 1.0, "positive", 0))
    assert content(table.only_new(batch)) == [("new", 1.0, "positive", 0)]
