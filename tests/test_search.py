import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import tables
from checks.queries import REGISTRY
from specloom.functions import vectors as V
from specloom.operators import candidates, ranking, similarity
from specloom.operators.keys import triangle
from specloom.plans.ms2ds import ms2ds_search
from specloom.plans.spec2vec import spec2vec_search
from tests.helpers import pairs, spectra

SIDE = "id string, mz double, vector array<double>, ion_mode string, request int"


def side(spark, rows, kind):
    df = spark.createDataFrame(rows, SIDE)
    named = df.select(
        F.col("id").alias(f"{kind}_id"),
        F.col("mz").alias(f"{kind}_mz"),
        F.col("vector").alias(f"{kind}_vector"),
        "ion_mode",
        F.col("request").alias("request_id"),
    )
    return named if kind == "query" else named.drop("request_id")


def random_rows(n, prefix, seed, hot=0.4):
    """Rows of which a share lies in one m/z bucket, with repeated and zero vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        mz = 250.0 + rng.uniform(0, 0.9) if rng.uniform() < hot else rng.uniform(240, 260)
        vector = [0.0] * 4 if i % 17 == 0 else [float(v) for v in rng.integers(-2, 3, 4)]
        rows.append((f"{prefix}{i:04d}", float(round(mz, 3)), vector, "positive" if i % 3 else "negative", i % 4))
    return rows


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    norms = math.sqrt(a @ a) * math.sqrt(b @ b)
    return round(float(a @ b) / norms, 6) + 0.0 if norms else None


def brute_force(queries, allowed, n):
    """allowed(query) gives the reference rows a query is scored against."""
    out = []
    for q in queries:
        scored = [(cosine(q[2], r[2]), r[0]) for r in allowed(q)]
        best = sorted([(-s, i) for s, i in scored if s is not None])[:n]
        out += [(q[0], i, -s + 0.0, k + 1) for k, (s, i) in enumerate(best)]
    return sorted(out)


def in_window(q, r, width):
    return q[3] == r[3] and q[1] - width <= r[1] <= q[1] + width


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_windowed_search_equals_brute_force(spark, block_rows):
    queries, refs = random_rows(60, "q", 1), random_rows(150, "r", 2)
    got = spec2vec_search(
        side(spark, queries, "query"), side(spark, refs, "ref"), 1.0, 5, "drop", block_rows=block_rows
    )
    expected = brute_force(queries, lambda q: [r for r in refs if in_window(q, r, 1.0)], 5)
    assert pairs(got, "query_id", "ref_id", "score", "rank") == expected


@pytest.mark.parametrize("block_rows", [9, 100_000])
def test_request_search_equals_brute_force(spark, block_rows):
    queries, refs = random_rows(40, "q", 3), random_rows(120, "r", 4)

    def allowed(q):
        mates = [p for p in queries if p[4] == q[4]]
        return [r for r in refs if r[3] == q[3] and any(in_window(p, r, 0.5) for p in mates)]

    got = ms2ds_search(side(spark, queries, "query"), side(spark, refs, "ref"), 0.5, 4, "drop", block_rows=block_rows)
    assert pairs(got, "query_id", "ref_id", "score", "rank") == brute_force(queries, allowed, 4)


@pytest.mark.parametrize("block_rows", [11, 100_000])
def test_matrix_equals_brute_force(spark, block_rows):
    queries, refs = random_rows(30, "q", 5), random_rows(50, "r", 6)
    got = similarity.cosine_matrix(side(spark, queries, "query"), side(spark, refs, "ref"), 50, block_rows=block_rows)
    assert pairs(got, "query_id", "ref_id", "score", "rank") == brute_force(queries, lambda q: refs, 50)


def test_self_similarity_is_symmetric_with_diagonal_one(spark):
    rows = [(r[0], r[2]) for r in random_rows(25, "x", 7)]
    df = spark.createDataFrame(rows, "spectrum_id string, vector array<double>")
    got = {(a, b): s for a, b, s in pairs(similarity.self_similarity(df, 100), "query_id", "ref_id", "score")}
    assert all(got[b, a] == s for (a, b), s in got.items())
    defined = [i for i, v in rows if any(v)]
    assert len(got) == len(defined) ** 2
    assert all(got[i, i] == 1.0 for i in defined)


@pytest.mark.parametrize(("block_rows", "at_once"), [(6, 4), (9, 100), (100_000, 16), (100_000, 4_000_000)])
def test_each_block_of_the_triangle_is_made_once(spark, monkeypatch, block_rows, at_once):
    """As the whole matrix, for any blocks and tiles, from about half of its blocks."""
    monkeypatch.setattr(similarity, "_SCORES_AT_ONCE", at_once)
    rows = [(r[0], r[2]) for r in random_rows(40, "x", 12)] + [("twin", random_rows(40, "x", 12)[0][2]), ("zero", [0.0] * len(random_rows(1, "x", 12)[0][2]))]
    df = spark.createDataFrame(rows, "spectrum_id string, vector array<double>")
    names = "query_id", "ref_id", "score", "rank"
    whole = similarity.cosine_matrix(similarity.as_queries(df), similarity.as_refs(df), 4)
    assert pairs(similarity.self_similarity(df, 4, block_rows=block_rows), *names) == pairs(whole, *names)
    left, right, cells = triangle(df, ["spectrum_id"], block_rows)
    made = left.select(*cells).distinct().join(right.select(*cells).distinct(), cells).count()
    parts = -(-len(rows) // block_rows)
    assert made <= parts * (parts + 1) // 2


@pytest.mark.parametrize("mz_range", [0.0, 0.05, 0.3, 1.0, 40.0])
def test_queries_without_candidates_equal_brute_force(spark, mz_range):
    """Found from bounds of buckets, also for windows that end on a bucket's border or a reference."""
    queries, refs = random_rows(60, "q", 18), random_rows(25, "r", 19)
    refs += [(f"b{k}", k * mz_range, queries[0][2], "positive", 0) for k in range(300, 310)]
    queries += [(f"c{k}", k * mz_range, queries[0][2], "positive", 0) for k in range(297, 315)]
    queries += [("null", None, queries[0][2], "positive", 0), ("other", queries[0][1], queries[0][2], "none such", 0)]
    left, right = side(spark, queries, "query"), side(spark, refs, "ref")
    expected = sorted(q[0] for q in queries if q[1] is None or not any(q[3] == r[3] and q[1] - mz_range <= r[1] <= q[1] + mz_range for r in refs))
    found = candidates.without_candidates(left, right, mz_range)
    assert sorted(r["query_id"] for r in found.collect()) == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "ref_id" not in plan  # bounds of buckets only


@pytest.mark.parametrize("block_rows", [5, 100_000])
def test_candidates_equal_brute_force_in_crowded_buckets(spark, block_rows):
    queries, refs = random_rows(50, "q", 8), random_rows(90, "r", 9)
    got = candidates.candidate_pairs(
        side(spark, queries, "query"), side(spark, refs, "ref"), 0.75, block_rows=block_rows
    )
    expected = sorted((q[0], r[0]) for q in queries for r in refs if in_window(q, r, 0.75))
    assert pairs(got, "query_id", "ref_id") == expected


def test_window_edges_belong_to_the_window(spark):
    queries = [("q", 200.0, [1.0], "positive", 0)]
    refs = [(f"r{m}", m, [1.0], "positive", 0) for m in (198.999, 199.0, 200.5, 201.0, 201.001)]
    got = candidates.precursor_candidates(side(spark, queries, "query"), side(spark, refs, "ref"))
    assert pairs(got, "ref_id") == [("r199.0",), ("r200.5",), ("r201.0",)]


def test_no_nested_loop_join(spark):
    queries, refs = random_rows(10, "q", 1), random_rows(10, "r", 2)
    plan = candidates.candidate_pairs(side(spark, queries, "query"), side(spark, refs, "ref"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_on_empty(spark):
    queries = side(spark, [("a", 200.0, [1.0], "positive", 0), ("far", 900.0, [1.0], "positive", 1)], "query")
    refs = side(spark, [("r", 200.2, [1.0], "positive", 0)], "ref")
    with pytest.raises(RuntimeError):
        candidates.precursor_candidates(queries, refs)
    with pytest.raises(ValueError):
        candidates.precursor_candidates(queries, refs, on_empty="skip")
    drop = candidates.precursor_candidates(queries, refs, on_empty="drop")
    keep = candidates.precursor_candidates(queries, refs, on_empty="keep")
    assert pairs(drop, "query_id", "ref_id") == [("a", "r")]
    assert {(r["query_id"], r["ref_id"]) for r in keep.collect()} == {("a", "r"), ("far", None)}
    for search in (spec2vec_search, ms2ds_search):
        with pytest.raises(RuntimeError):
            search(queries, refs, on_empty="raise")
        kept = search(queries, refs, on_empty="keep").collect()
        assert {(r["query_id"], r["ref_id"]) for r in kept} == {("a", "r"), ("far", None)}


def test_kept_queries_are_found_without_the_pairs(spark):
    queries, refs = random_rows(50, "q", 8), random_rows(40, "r", 9)
    queries += [("null", None, queries[0][2], "positive", 0), ("q0", 9000.0, queries[0][2], "positive", 0)]
    keep = candidates.precursor_candidates(side(spark, queries, "query"), side(spark, refs, "ref"), 0.3, "keep")
    text = keep._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Inner") == 1
    found = [(q[0], r[0]) for q in queries for r in refs if q[1] and in_window(q, r, 0.3)]
    empty = [(q[0], "") for q in queries if q[0] not in {x for x, _ in found}]
    assert sorted((r["query_id"], r["ref_id"] or "") for r in keep.collect()) == sorted(found + empty)


@pytest.mark.parametrize("mz_range", [0.0, 0.3, 40.0])
def test_union_of_candidates_equals_brute_force_and_makes_no_pairs(spark, mz_range):
    queries, refs = random_rows(60, "q", 18), random_rows(25, "r", 19)
    refs += [(f"b{k}", k * mz_range, queries[0][2], "positive", 0) for k in range(300, 310)]
    queries += [(f"c{k}", k * mz_range, queries[0][2], "positive", k % 3) for k in range(297, 315)] + [("null", None, queries[0][2], "positive", 0)]
    left = side(spark, queries, "query")
    found = candidates.union_candidates(left, side(spark, refs, "ref"), mz_range)
    want = {(q[4], r[0]) for q in queries for r in refs if q[1] is not None and q[3] == r[3] and q[1] - mz_range <= r[1] <= q[1] + mz_range}
    assert pairs(found, "request_id", "ref_id") == sorted(want)
    assert "query_id" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block_rows", [5, 100_000])
def test_a_ranking_takes_the_best_of_each_block(spark, block_rows):
    left, right = side(spark, random_rows(50, "q", 8), "query"), side(spark, random_rows(90, "r", 9), "ref")
    every = candidates.score_candidates(left, right, 0.75, block_rows=block_rows)
    few = candidates.score_candidates(left, right, 0.75, block_rows=block_rows, n_best=2)
    names = "query_id", "ref_id", "score", "rank"
    assert pairs(ranking.top_n_matches(few, 2), *names) == pairs(ranking.top_n_matches(every, 2), *names)
    assert few.count() < every.count()


def test_scores_of_a_block_come_out_in_tiles(monkeypatch):
    monkeypatch.setattr(similarity, "_TILE", 4)
    queries, refs = ([r for r in random_rows(n, p, n) if any(r[2])] for n, p in ((50, "q"), (90, "r")))
    columns = [(q[0], q[1], q[2], True) for q in queries] + [(r[0], r[1], r[2], False) for r in refs]
    block = pa.RecordBatch.from_pydict(dict(zip(("id", "mz", "vector", "_left"), map(list, zip(*columns)))))
    tiles = list(similarity.pair_scorer(0.75, None)(iter([block])))
    assert max(t.num_rows for t in tiles) <= 16
    got = sorted((r["query_id"], r["ref_id"]) for t in tiles for r in t.to_pylist())
    assert got == sorted((q[0], r[0]) for q in queries for r in refs if q[1] - 0.75 <= r[1] <= q[1] + 0.75)


@pytest.mark.parametrize("block_rows", [5, 100_000])
def test_candidates_are_scored_in_blocks(spark, block_rows):
    queries, refs = random_rows(50, "q", 8), random_rows(90, "r", 9)
    refs += [("zero", queries[0][1], [0.0] * len(queries[0][2]), queries[0][3], 0), ("null", None, queries[0][2], queries[0][3], 0)]
    left, right = side(spark, queries, "query"), side(spark, refs, "ref")
    plain = similarity.score_pairs(candidates.candidate_pairs(left, right, 0.75).select("query_id", "ref_id", "query_vector", "ref_vector"))
    names = "query_id", "ref_id", "score"
    scored = candidates.score_candidates(left, right, 0.75, undefined=0.0, block_rows=block_rows)
    assert pairs(scored, *names) == pairs(plain, *names)
    undefined = candidates.score_candidates(left, right, 0.75, block_rows=block_rows).filter("score is null")
    zero = {x[0] for x in queries + refs if not any(x[2])}
    assert pairs(undefined, "query_id", "ref_id") == [(a, b) for a, b, _ in pairs(plain, *names) if a in zero or b in zero]
    assert "MapGroupsInArrow" in scored._jdf.queryExecution().executedPlan().toString()


def test_range_is_ordered_and_unbounded_by_none(spark):
    df = spectra(spark, {"precursor_mz": 3.0}, {"precursor_mz": 1.0}, {"precursor_mz": 2.0}, {"precursor_mz": 2.0})
    ids = [r["spectrum_id"] for r in candidates.precursor_range(df, 2.0, 3.0).collect()]
    assert ids == ["s2", "s3", "s0"]
    assert candidates.precursor_range(df, max_mz=2.0).count() == 3
    assert candidates.precursor_range(df).count() == 4


def test_zero_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [0.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(V.cosine_pair(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]
    assert [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [None, 1.0]


def test_lengths_must_agree(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="differ in length"):
        df.select(V.cosine_pair(F.col("a"), F.col("b"))).collect()


def test_top_n_ignores_undefined_scores_and_breaks_ties_by_id(spark):
    rows = [("q", "c", 0.5), ("q", "b", 0.5), ("q", "a", float("nan")), ("q", "d", None), ("q", "e", 0.9)]
    df = spark.createDataFrame(rows, "query_id string, ref_id string, score double")
    assert pairs(ranking.top_n_matches(df, 2), "rank", "ref_id") == [(1, "e"), (2, "b")]
    assert ranking.top_n_matches(df, 0).count() == 3
    nested = ranking.nest_matches(ranking.top_n_matches(df)).first()
    assert nested["matches"] == {"e": 0.9, "b": 0.5, "c": 0.5}


def test_partial_limit_precedes_the_shuffle(spark):
    df = spark.createDataFrame([("q", "c", 0.5)], "query_id string, ref_id string, score double")
    plan = ranking.top_n_matches(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_metadata_of_matches(spark):
    matches = spark.createDataFrame([("q", "s0", 1), ("q", "gone", 2)], "query_id string, ref_id string, rank int")
    library = spectra(spark, {"metadata": {"a": "1", "b": "2"}})
    everything = {r["ref_id"]: r["metadata"] for r in ranking.attach_metadata(matches, library).collect()}
    assert everything == {"s0": {"a": "1", "b": "2"}, "gone": None}
    some = {r["ref_id"]: r["metadata"] for r in ranking.attach_metadata(matches, library, ["b"]).collect()}
    assert some["s0"] == {"b": "2"}


def test_candidate_embeddings_of_one_project_and_mode(spark):
    found = spark.createDataFrame([("q", "a"), ("q", "b"), ("q", "c")], "query_id string, ref_id string")
    table = spark.createDataFrame(
        [("a", [1.0], "p", "positive"), ("b", [2.0], "other", "positive"), ("c", [3.0], "p", "negative")],
        "spectrum_id string, vector array<double>, project string, ion_mode string",
    )
    assert pairs(candidates.candidate_embeddings(found, table, "p", "positive"), "ref_id", "ref_vector") == [("a", [1.0])]


def test_vectors_fetched_before_or_after_the_pairs(spark):
    queries, refs = random_rows(60, "q", 31), random_rows(80, "r", 32)
    refs += refs[:5]  # ids that repeat
    table = [(r[0], r[2] if i % 7 else None, "p" if i % 5 else "other", r[3]) for i, r in enumerate(refs[:70])]
    table += [(None, [9.0], "p", "positive"), ("nobody", [9.0], "p", "positive"), table[1]]
    table = spark.createDataFrame(table, "spectrum_id string, vector array<double>, project string, ion_mode string")
    left, right = side(spark, queries, "query"), side(spark, refs, "ref")
    for mz_range in (0.0, 0.7):
        made = candidates.precursor_candidates(left, right, mz_range, "drop")
        after = candidates.candidate_embeddings(made, table, "p", "positive")
        before = candidates.window_embeddings(left, right, table, "p", "positive", mz_range)
        rows = [sorted(map(str, df.select("query_id", "ref_id", "ref_vector").collect())) for df in (after, before)]
        assert rows[0] == rows[1] and (rows[0] or not mz_range)


def test_pairs_are_not_shuffled_for_their_vectors(spark, monkeypatch):
    monkeypatch.setattr(tables, "_stored", {})
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        found = REGISTRY["candidate_embeddings"](spark, "/root/testdata/sf0.001")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    above, window, below = plan.partition(">= (query_mz")
    assert window and "Exchange" not in above and "Exchange" in below


@pytest.mark.parametrize("block_rows", [7, None])
@pytest.mark.parametrize("tile", [8, 1024])
def test_window_search_with_copies_ties_and_many_tiles(spark, monkeypatch, block_rows, tile):
    monkeypatch.setattr(similarity, "_TILE", tile)
    queries = [(f"{i}{r[0]}", *r[1:]) for r in random_rows(60, "q", 21) for i in range(3)]
    refs = [(f"{i}{r[0]}", *r[1:]) for r in random_rows(80, "r", 22) for i in range(4)]
    # Windows that end on a bucket's edge, by the sums that doubles give.
    refs += [("edge", 251.0 + 0.3, [1.0, 0.0, 0.0, 0.0], "positive", 0)]
    queries += [("edge", 250.3, [1.0, 0.0, 0.0, 0.0], "positive", 0)]
    if block_rows is None:
        scorer = similarity._window_scorer(5, 6, 1.0)
        for mode in ("positive", "negative"):
            q, r = ([x for x in rows if x[3] == mode] for rows in (queries, refs))
            table = lambda rows, p: pa.table({f"{p}_id": [x[0] for x in rows], f"{p}_mz": [x[1] for x in rows], f"{p}_vector": [x[2] for x in rows]})
            got = sorted(tuple(m.values()) for m in scorer(table(q, "query"), table(r, "ref")).to_pylist())
            assert got == brute_force(q, lambda x: [y for y in r if in_window(x, y, 1.0)], 5)
        return
    found = spec2vec_search(side(spark, queries, "query"), side(spark, refs, "ref"), 1.0, 5, "drop", block_rows=block_rows)
    assert pairs(found, "query_id", "ref_id", "score", "rank") == brute_force(queries, lambda q: [r for r in refs if in_window(q, r, 1.0)], 5)


def test_a_window_search_shuffles_no_match(spark):
    queries, refs = side(spark, random_rows(30, "q", 23), "query"), side(spark, random_rows(30, "r", 24), "ref")
    plan = spec2vec_search(queries, refs, 1.0, 5, "drop")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_a_block_of_the_triangle_takes_little_memory():
    import tracemalloc

    vectors = np.random.default_rng(5).random((4096, 8)) - 0.5
    block = pa.table({"spectrum_id": [f"s{i:05d}" for i in range(4096)], "vector": pa.array(list(vectors), pa.list_(pa.float64()))})
    tracemalloc.start()
    found = similarity._triangle_scorer(3, 6)((0, 1), block, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 2 * 3 * 4096 and peak < 80e6


@pytest.mark.parametrize("mz_range", [0.0, 0.1, 1.0])
def test_few_queries_go_to_the_references(spark, mz_range):
    """References are not shuffled, and pairs are those of the windows, at the edges of buckets too."""
    rng = np.random.default_rng(11)
    odd = [None, math.nan, math.inf, -math.inf, 0.3, -0.1, 0.1 + 0.2, 3.0, 2.9999999999999996]
    mzs = odd + [round(float(x), 1) for x in rng.uniform(0, 8, 60)]
    rows = [(f"r{i:03d}", mz, [1.0], "positive" if i % 3 else "negative", 0) for i, mz in enumerate(mzs)]
    queries, refs = side(spark, rows, "query"), side(spark, rows, "ref")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = candidates.precursor_candidates(queries, refs, mz_range, "drop")
        assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
        got = pairs(made, "query_id", "ref_id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    many = pairs(candidates.candidate_pairs(queries, refs, mz_range), "query_id", "ref_id")
    number = [r for r in rows if r[1] is not None and not math.isnan(r[1])]
    want = sorted((q[0], r[0]) for q in number for r in number if in_window(q, r, mz_range))
    nan = rows[1][0]
    assert got == many == sorted([*want, (nan, nan)])


def test_the_whole_library_is_searched_without_its_metadata(spark, monkeypatch):
    monkeypatch.setattr(tables, "_stored", {})
    assert REGISTRY["spec2vec_search"](spark, "/root/testdata/sf0.001").count() > 0
    names = {name for _, _, name in tables._stored}
    assert "peak-spectra" in names and not names & {"spectra", "raw"}
