import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.operators import chunks
from specloom.operators.greedy_chunks import greedy_chunks, range_map
from tests.helpers import column, raw


def ids(spark, n):
    return spark.range(n).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("spectrum_id")).repartition(7)


def test_positions_count_up_in_order(spark):
    got = chunks.with_position(ids(spark, 1000), ["spectrum_id"]).orderBy("spectrum_id").collect()
    assert [r["position"] for r in got] == list(range(1000))


def test_positions_of_repeated_ids_are_still_complete(spark):
    df = spark.range(500).select(F.lit("same").alias("spectrum_id"), F.col("id").alias("n"))
    got = chunks.with_position(df, ["spectrum_id"])
    assert sorted(r["position"] for r in got.collect()) == list(range(500))


def test_chunks_of_ids(spark):
    got = chunks.chunk_ids(ids(spark, 100), 10)
    sizes = [r["count"] for r in got.groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [10] * 10
    assert chunks.chunk_ids(ids(spark, 95), 10).filter("chunk = 9").count() == 5


def test_chunks_by_bytes_keep_all_records_in_order(spark):
    df = raw(spark, *[{"spectrum_id": f"s{i:03d}", "peaks_json": "x" * (i * 37 % 900)} for i in range(200)])
    got = chunks.chunk_by_bytes(df.repartition(5), 20_000, rule="offset").orderBy("spectrum_id").collect()
    assert [r["spectrum_id"] for r in got] == [f"s{i:03d}" for i in range(200)]
    start = 0
    for i, row in enumerate(got):
        assert row["n_bytes"] == i * 37 % 900 + chunks.RECORD_OVERHEAD
        assert row["chunk"] == start // 20_000
        start += row["n_bytes"]


def closed_one_after_another(sizes, limit):
    out, chunk, held = [], 0, 0
    for size in sizes:
        out.append(chunk)
        held += size
        if held >= limit:
            chunk, held = chunk + 1, 0
    return out


@pytest.mark.parametrize("limit", [1, 1184, 5_000, 20_000, 10**9])
@pytest.mark.parametrize(("parts", "fan"), [(1, 16), (23, 2), (23, 16)])
def test_greedy_chunks_equal_the_sequential_rule(spark, limit, parts, fan):
    draw = random.Random(limit + parts)
    sizes = [draw.choice([1, 3, 500, 1184, 4_000, 30_000]) for _ in range(400)]
    cuts = sorted(draw.sample(range(1, 400), parts - 1))
    rows = [(f"s{i:03d}", size, sum(i >= c for c in cuts), i) for i, size in enumerate(sizes)]
    placed = spark.createDataFrame(rows, "spectrum_id string, n_bytes long, _part int, _line long").repartition(3)
    got = greedy_chunks(placed, limit, "spectrum_id", fan).orderBy("spectrum_id").collect()
    assert [r["n_bytes"] for r in got] == sizes
    assert [r["chunk"] for r in got] == closed_one_after_another(sizes, limit)


def test_maps_of_ranges_compose_for_any_open_bytes():
    draw = random.Random(3)
    for _ in range(300):
        limit = draw.randrange(1, 40)
        sizes = [draw.choice([0, 1, 2, 5, 13, 60]) for _ in range(draw.randrange(2, 12))] + [1]
        cut = draw.randrange(1, len(sizes))
        whole = range_map(np.array(sizes[:cut]) + 0, limit) if sum(sizes[:cut]) else None
        if whole is None or not sum(sizes[cut:]):
            continue
        whole = whole.then(range_map(np.array(sizes[cut:]), limit))
        for open_ in range(limit):
            held, closed = open_, 0
            for size in sizes:
                held += size
                if held >= limit:
                    held, closed = 0, closed + 1
            end, n, _ = whole(np.array([open_]))
            assert (int(end[0]), int(n[0])) == (held, closed)


def test_chunks_by_bytes_of_nothing_and_unknown_rules(spark):
    assert chunks.chunk_by_bytes(raw(spark, {}).limit(0)).count() == 0
    with pytest.raises(ValueError, match="rule"):
        chunks.chunk_by_bytes(raw(spark, {}), rule="other")


def test_id_sets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "spectrum_id string")
    b = spark.createDataFrame([("y",), ("z",)], "spectrum_id string")
    assert column(chunks.id_difference(a, b), "spectrum_id") == ["x"]
    assert column(chunks.id_union([a, b]), "spectrum_id") == ["x", "y", "z"]
    assert column(chunks.id_intersection(a, b), "spectrum_id") == ["y"]
    assert chunks.flatten_batches([a, b]).count() == 5
