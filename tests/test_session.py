import pytest

from specloom import session
from specloom.session import materialise, new_path, remove_intermediates, shared_dir
from specloom.sources import datasets, library, store


class Cluster:
    """A session on a cluster whose settings name no shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError):
        shared_dir(Cluster)


def test_one_machine_may_name_none(spark):
    class Laptop:
        conf, sparkContext = Cluster.conf, spark.sparkContext

    assert shared_dir(Laptop) == shared_dir(Laptop)


def test_intermediates_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    assert materialise(spark.range(3), "numbers").count() == 3
    remove_intermediates(spark)
    assert not (tmp_path / "specloom").exists()


def test_only_whole_partitions_are_dropped(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, "p", "a b"), (2, "p", "c"), (3, "q", "c")], "x int, one string, two string").write.partitionBy("one", "two").parquet(path)
    with pytest.raises(ValueError):
        datasets.drop_partition(spark, path)
    with pytest.raises(ValueError):
        datasets.drop_partition(spark, path, one="p")
    datasets.drop_partition(spark, path, two="a b", one="p")
    datasets.drop_partition(spark, path, two="none", one="p")
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [2, 3]


def test_new_rows_hold_each_id_once(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "spectrum_id string, x int")
    new = store.new_rows(batch, batch.filter("spectrum_id = 'b'")).collect()
    assert [r.spectrum_id for r in new] == ["a"]


def test_embeddings_are_replaced_also_by_none(spark, tmp_path):
    path = str(tmp_path / "embeddings")
    rows = spark.createDataFrame([("a", "s", "positive"), ("b", "s", "negative")], "spectrum_id string, project string, ion_mode string")
    for mode in ("positive", "negative"):
        store.replace_embeddings(spark, rows.filter(rows.ion_mode == mode), path, "s", mode)
    assert store.replace_embeddings(spark, rows.limit(0), path, "s", "positive").count() == 0
    assert [r.spectrum_id for r in spark.read.parquet(path).collect()] == ["b"]


def test_a_repeated_mgf_key_keeps_its_last_value(spark, tmp_path):
    path = tmp_path / "x.mgf"
    path.write_text("BEGIN IONS\nSPECTRUM_ID=s\nNAME=one\nNAME=two\nPRECURSOR_MZ=5\n10 1\nEND IONS\n")
    got = library.read_library_mgf(spark, str(path)).collect()
    assert [(r.spectrum_id, r.compound_name, r.metadata["name"]) for r in got] == [("s", "two", "two")]
    assert new_path(spark, "x") != new_path(spark, "x")
