"""The stages on small documents: each does its work on all that the one before kept."""

import corpus_pipeline
from specloom.session import ship_package
from tests.llm.texts import ODD, edited, words


def test_pipeline(spark, tmp_path):
    ship_package(spark)
    base, item = words(1, 80), words(2, 40)
    rows = [(i, " ".join(words(10 + i, 60))) for i in range(120)]
    rows += [(200 + i, " ".join(base if i < 2 else edited(base, i, 0.02))) for i in range(4)]
    rows += [(300, " ".join(words(7, 30) + item)), (301, "p\nq\nr\nown"), (302, "p\nq\nr\nmine"), (302, "p\nq\nr\nmine"), *ODD]
    toxic = [(i, " ".join([*words(10 + i, 20), "blorg", "blorgs"])) for i in range(1000, 1060)]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows + toxic], "doc_id long, text string, lang string, source string, n_chars long, `text.n` int").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(120)] + [(i, 0, 1) for i in range(1000, 1060)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        seen[name] = docs.collect()
    odd = {i for i, _ in ODD}
    ids = {name: {r.doc_id for r in found} for name, found in seen.items()}
    assert ids["toxicity"] == {i for i, _ in rows}
    texts = {r.doc_id: r for r in seen["line_dedup"]}
    assert texts[301].text == "p\nq\nr\nown" and texts[302].text == "mine" and texts[302].n_chars == 4
    assert ids["ngram_jaccard_join"] == {*range(120), 200, 300, 301, 302, *odd} - {9005}
    assert sum(r.doc_id == 302 for r in seen["ngram_jaccard_join"]) == 1
    assert ids["benchmark_decontamination"] == ids["ngram_jaccard_join"] - {300}
    last = seen["sentencepiece_merge_dropout"]
    assert {r.doc_id for r in last} == ids["benchmark_decontamination"] and all(r.round_trip for r in last)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(last)
