"""Files by m/z: the same rows, from few files."""

import random

import pytest
from pyspark.sql import functions as F

from specloom.operators.candidates import candidate_pairs
from specloom.sources.clustered import clustered_near, clustered_range, file_bounds, write_clustered


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    draw = random.Random(1)
    rows = [(f"s{i:04d}", 250.0 if i % 4 == 0 else round(draw.uniform(50, 900), 3), "positive" if i % 3 else "negative", float(i)) for i in range(2000)]
    rows += [("null", None, "positive", 0.0), ("edge", 300.0, "positive", 0.0)]
    df = spark.createDataFrame(rows, "spectrum_id string, precursor_mz double, ion_mode string, x double")
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    write_clustered(df, path, n_files=40)
    return df, path


def content(df):
    return sorted(map(tuple, df.select("spectrum_id", "precursor_mz", "ion_mode", "x").collect()))


@pytest.mark.parametrize(("low", "high"), [(300.0, 301.5), (None, 60.0), (880.0, None), (250.0, 250.0), (1000.0, None), (301.0, 300.0)])
def test_a_range_reads_few_files(spark, library, low, high):
    df, path = library
    want = df.filter("ion_mode = 'positive'")
    want = want.filter(F.col("precursor_mz") >= low) if low is not None else want
    want = want.filter(F.col("precursor_mz") <= high) if high is not None else want
    got = clustered_range(spark, path, low, high, ion_mode="positive")
    assert content(got) == content(want)
    files = file_bounds(spark, path).select("file").distinct().count()
    assert files > 30 and len(got.inputFiles()) <= files // 3
    assert not got.inputFiles() or "PushedFilters: [" in got._jdf.queryExecution().executedPlan().toString()


def test_everything_without_bounds(spark, library):
    df, path = library
    assert content(clustered_range(spark, path)) == content(df)
    assert file_bounds(spark, path).agg(F.sum("n_rows")).first()[0] == df.count()


def test_references_near_queries_are_all_there(spark, library):
    df, path = library
    queries = spark.createDataFrame([("q1", 300.4, "positive"), ("q2", 700.0, "negative"), ("q3", None, "positive")], "query_id string, query_mz double, ion_mode string")
    refs = clustered_near(spark, path, queries, 0.5)
    side = lambda d: d.select(F.col("spectrum_id").alias("ref_id"), F.col("precursor_mz").alias("ref_mz"), "ion_mode")
    found = sorted((r.query_id, r.ref_id) for r in candidate_pairs(queries, side(refs), 0.5).collect())
    assert found == sorted((r.query_id, r.ref_id) for r in candidate_pairs(queries, side(df), 0.5).collect()) and found
    assert len(refs.inputFiles()) <= 6
    assert clustered_near(spark, path, queries.limit(0), 0.5).count() == 0
