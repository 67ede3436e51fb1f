"""Toxicity, decontamination and language ID."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from specloom.llm import decontaminate, language_id
from specloom.llm import toxicity as toxicity_module
from specloom.llm.decontaminate import align, benchmark_copies, without_copies
from specloom.llm.language_id import Texts, Vocabulary, Words, identify_languages
from specloom.llm.merge_dropout import MODEL
from specloom.llm.toxicity import fit_sample, toxicity, without_toxic
from tests.llm.texts import ODD, edited, words


def labelled(n=400):
    """Texts of which a tenth has an insult; every second one is labelled."""
    rows = []
    for i in range(n):
        w = words(i, 40)
        if i % 10 == 0:
            w[random.Random(i).randrange(40)] = f"blorg{i % 7}"
            w[random.Random(i + 1).randrange(40)] = "Blorgish"
        rows.append((i, " ".join(w)))
    return rows, [(i, 1, int(i % 10 == 0)) for i in range(n)]


def test_toxicity_learns_and_never_sees_held_out_labels(spark, documents):
    rows, labels = labelled()
    docs = documents(rows + ODD + [(5, rows[5][1])])
    table = spark.createDataFrame([*labels, (9001, 0, 0), (9004, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity(docs, table).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert held and all(r.predicted == int(r.doc_id % 10 == 0) for r in held)
    turned = table.withColumn("toxic", (1 - table.toxic))
    import binascii

    from pyspark.sql import functions as F

    ids = [i for i in range(400) if binascii.crc32(str(i).encode()) % 3 == 1]
    mixed = table.filter(~table.doc_id.isin(ids)).unionByName(turned.filter(F.col("doc_id").isin(ids)).select(*table.columns))
    again = {r.doc_id: r.score for r in toxicity(docs, mixed).collect()}
    assert all(again[r.doc_id] == r.score for r in got)
    kept = without_toxic(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 400} == {i for i in range(400) if i % 10}


def test_toxicity_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity(documents(ODD), none).collect()} == {0.0}
    assert toxicity(documents([]), none).collect() == []


def test_rare_toxic_labels_are_all_in_the_sample(spark):
    rows = [(i, int(i % 1000 == 3)) for i in range(20_000)] + [(None, 1), (20_001, None), (20_002, 2)]
    sample, total = fit_sample(spark.createDataFrame(rows, "doc_id long, label int"), 400)
    got = sample.collect()
    assert total[1] == 20 and total[0] == 19_980 and len(got) == 400
    assert {r.doc_id for r in got if r.label == 1} == {i for i, label in rows if label == 1 and i is not None}
    assert {r.weight for r in got if r.label == 1} == {1.0}
    assert [r.weight for r in got if r.label == 0] == [pytest.approx(19_980 / 380)] * 380
    half, _ = fit_sample(spark.createDataFrame([(i, 1) for i in range(1000)], "doc_id long, label int"), 400)
    assert half.count() == 200 and {r.weight for r in half.collect()} == {5.0}


def test_few_toxic_labels_leave_the_lexicon(spark, documents):
    """Too few toxic labels for trees: strong words decide, and a text with none has the base rate."""
    rows, _ = labelled(600)
    rows = [(i, t) if i < 60 or i % 10 else (i, " ".join(words(i, 40))) for i, t in rows] + [(700, rows[0][1]), (700, "other words here")]
    table = spark.createDataFrame([(i, int(i < 60 and i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity(documents([*rows, *ODD]), table).collect()
    of = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id < 600}
    assert all(of[i].predicted == int(i < 60 and i % 10 == 0) for i in of)
    assert len({r.score for r in got}) > 1
    again = {(r.doc_id, r.score) for r in toxicity(documents([*rows, *ODD]).repartition(7), table).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def slow_features(text, lexicon):
    """Some of the features, word by word."""
    import re

    raw = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    core = [c for c in (re.sub(r"^[^A-Za-z0-9$@\x80-\U0010ffff]+|[^A-Za-z0-9$@\x80-\U0010ffff]+$", "", w) for w in raw) if c]
    low = [c.lower() if c.isascii() else "".join(x.lower() if x.isascii() else x for x in c) for c in core]
    n_words, n_bytes = max(len(raw), 1), max(len(text.encode()), 1)
    pronoun = [w in toxicity_module.PRONOUNS.split() for w in low]
    hit = [w in lexicon for w in low]
    near = [h and any(pronoun[max(i - toxicity_module.NEAR, 0) : i + toxicity_module.NEAR + 1]) for i, h in enumerate(hit)]
    signs = "!?.,;:-_*#%&$@\"'()[]{}<>/\\|~^+="
    return {
        "lexicon_words": sum(hit),
        "lexicon_share": sum(hit) / n_words,
        "lexicon_best": max([lexicon.get(w, 0.0) for w in low], default=0.0),
        "near_pronouns": sum(near),
        "pronoun_share": sum(pronoun) / n_words,
        "capital_share": sum("A" <= x <= "Z" for x in text) / n_bytes,
        "shouted_share": sum(len(c) >= 2 and all("A" <= x <= "Z" for x in c) for c in core) / n_words,
        "mark_share": sum(x in signs for x in text) / n_bytes,
        "exclamation_share": sum(x in "!?" for x in text) / n_bytes,
        "log_words": math.log1p(len(raw)),
        "repeated_share": sum(a == b for a, b in zip(low, low[1:])) / n_words,
    }


def test_features_equal_slow_ones():
    draw = random.Random(4)
    lexicon = {"blorg": 3.0, "zap": 6.0}
    spans = toxicity_module._spans_of(list(lexicon))
    fast = toxicity_module.Lexicon(toxicity_module.K.span_hashes(*spans), np.array(list(lexicon.values())))
    parts = ["you", "Your", "zap", "ZAP", "blorg!", "(blorg)", "hello", "A", "OK", "--", "x", "été", "...", "du", "no?", "n0"]
    texts = [draw.choice(["", " ", "\n"]) + draw.choice([" ", "\t\n"]).join(draw.choices(parts, k=draw.randrange(40))) for _ in range(200)]
    texts += ["", "   ", "zap " * 5000, "!" * 3000]
    got = toxicity_module.features(pa.RecordBatch.from_pydict({"text": pa.array(texts)}), fast)
    for text, row in zip(texts, got):
        for name, value in slow_features(text, lexicon).items():
            assert row[toxicity_module.FEATURES.index(name)] == pytest.approx(value), (name, text[:80])


def slow_alignment(item, text):
    best = 0
    table = np.zeros((len(item) + 1, len(text) + 1), int)
    for i in range(len(item)):
        for j in range(len(text)):
            step = table[i, j] + (2 if item[i] == text[j] else -1)
            table[i + 1, j + 1] = max(0, step, table[i, j + 1] - 1, table[i + 1, j] - 1)
            best = max(best, table[i + 1, j + 1])
    return best


def test_alignment_equals_the_plain_recurrence():
    draw = np.random.default_rng(0)
    for _ in range(60):
        item, text = draw.integers(0, 5, draw.integers(1, 20)), draw.integers(0, 5, draw.integers(1, 30))
        assert align(item, text)[0] == slow_alignment(item, text)


def test_copies_are_found_edited_or_not_and_clean_texts_stay(spark, documents):
    items = [(i, " ".join(words(1000 + i, 40))) for i in range(5)]
    leak = lambda i, share: " ".join(words(i, 30) + edited(words(1000 + i % 5, 40), i, share) + words(i + 9, 20))
    rows = [(i, leak(i, 0.0)) for i in range(10)] + [(20 + i, leak(i, 0.15)) for i in range(10)]
    rows += [(100 + i, " ".join(words(500 + i, 200))) for i in range(40)]
    # One item leaked very often: its seeds are frequent and yet must find it.
    rows += [(300 + i, items[0][1].upper() + "!") for i in range(120)] + ODD
    benchmark = spark.createDataFrame([*items, (6, None), (7, ""), (8, "two words"), (None, "x y z a b")], "item_id long, text string")
    got = benchmark_copies(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i % 5) for i in range(10)} | {(20 + i, i % 5) for i in range(10)} | {(300 + i, 0) for i in range(120)}
    exact = next(r for r in got if r.doc_id == 3)
    assert (exact.score, exact.first_word, exact.end_word) == (1.0, 30, 70)
    kept = without_copies(documents(rows), benchmark)
    assert {r.doc_id for r in kept.collect() if r.doc_id} == {100 + i for i in range(40)} | {i for i, _ in ODD if i}
    assert benchmark_copies(documents([]), benchmark).collect() == []
    assert benchmark_copies(documents(rows), benchmark.limit(0)).collect() == []


def test_partial_and_edited_versions_in_many_documents_are_found(spark, documents):
    items = [words(8000 + i, 40) for i in range(3)] + [words(8010, 200)]
    version = items[1].copy()
    for at in (5, 15, 25, 35):
        version[at] = f"new{at}"
    parts = [items[0][10:26], version, items[2], items[3][60:100]]
    rows = [(1000 * k + i, " ".join(words(1000 * k + i, 30) + p + words(7 * i + k, 20))) for k, p in enumerate(parts) for i in range(1, 101)]
    rows += [(5000, " ".join(items[1])), (5001, " ".join(items[0])), (5002, " ".join(items[3])), (5003, " ".join(words(1, 300)))]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    expected = {(1000 * k + i, k) for k in range(4) for i in range(1, 101)} | {(5000, 1), (5001, 0), (5002, 3)}
    assert {(r.doc_id, r.item_id) for r in benchmark_copies(documents(rows), benchmark).collect()} == expected
    assert {r.doc_id for r in without_copies(documents(rows), benchmark).collect()} == {5003}


def test_no_alignment_exceeds_its_bound():
    draw = np.random.default_rng(1)
    items = [(i, " ".join(f"a{x}" for x in draw.integers(0, 6, draw.integers(3, 20)))) for i in range(8)]
    seeds = decontaminate.Seeds(items, 3)
    hashes = np.concatenate([seeds.words[i] for i in draw.integers(0, 8, 40)])
    low = draw.integers(0, len(hashes) - 40, 200)
    high, item = low + draw.integers(1, 40, 200), draw.integers(0, 8, 200)
    bounds = decontaminate._bounds(hashes, item, low, high, seeds)
    assert all(align(seeds.words[i], hashes[a:b])[0] <= x for i, a, b, x in zip(item, low, high, bounds))


def test_blocks_of_items_give_the_same(spark, documents, monkeypatch):
    items = [(i, " ".join(words(1000 + i, 40))) for i in range(6)]
    rows = [(i, " ".join(words(i, 30)) + " " + items[i][1]) for i in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, benchmark_copies(documents(rows), benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    assert sorted(map(tuple, benchmark_copies(documents(rows), benchmark).collect())) == whole


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as f:
        return Vocabulary(f.read())


def all_segmentations(word, pieces, log_p, vocabulary):
    word, total = "▁" + word.lower(), [0.0] * (len(word) + 2)
    total[0] = 1.0
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - vocabulary.longest), j):
            if word[i:j] in pieces:
                total[j] += total[i] * math.exp(log_p[pieces[word[i:j]]])
            elif j - i == 1:
                total[j] += total[i] * math.exp(sum(log_p[vocabulary.byte_ids[b]] for b in word[i:j].encode()))
    return math.log(total[len(word)])


@pytest.mark.parametrize("extra", [[], ["abcdefgh" * 20]])
def test_forward_sums_all_segmentations(vocabulary, extra):
    p = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = {p.id_to_piece(i): i for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))}
    log_p = np.log(vocabulary.start)
    texts = ["Hello World the the çà", "", "Straße ሴx 東京 foo123!?", *extra]
    own = Texts(texts)
    found = Words(own, np.arange(len(own.keys)), vocabulary)
    totals = np.zeros(len(own.keys))
    totals[found.which] = found.totals(np.exp(found.edge_logs(log_p[:, None], vocabulary)))[:, 0]
    if not extra:
        want = [all_segmentations(w, pieces, log_p, vocabulary) for t in texts for w in t.split()]
        assert np.allclose(totals[own.word], want)
    else:
        want = [all_segmentations(w, pieces, log_p, vocabulary) for t in texts[:3] for w in t.split()]
        assert np.allclose(totals[own.word][:-1], want) and np.isfinite(totals).all()


def test_languages_are_told_apart(spark, documents):
    said = {"en": "the house and the garden with water", "de": "das haus und der garten mit wasser für ihn", "fr": "la maison et le jardin avec de l'eau"}
    rows = []
    for n, (lang, text) in enumerate(said.items()):
        w = text.split()
        rows += [documents([(100 * n + i, " ".join(random.Random(i).choices(w, k=12))) for i in range(40)], lang)]
    docs = rows[0].unionByName(rows[1]).unionByName(rows[2])
    odd = documents([*ODD, (9010, "123 !?"), (None, "das haus")], None)
    got = identify_languages(docs.unionByName(odd)).collect()
    assert len(got) == 120 + len(ODD) + 2
    assert all(r.lang_pred == list(said)[r.doc_id // 100] and r.score > 0.9 for r in got if r.doc_id is not None and r.doc_id < 300)
    assert {(r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id in (9001, 9002, 9003, 9010)} == {(i, "und", 0.0) for i in (9001, 9002, 9003, 9010)}
    assert any(r.held_out for r in got) and not all(r.held_out for r in got)
    assert {r.lang_pred for r in identify_languages(odd).collect()} == {"und"}
    assert identify_languages(documents([])).collect() == []


def test_too_many_languages_are_refused(documents, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 0)
    with pytest.raises(ValueError):
        identify_languages(documents([(1, "text"), (3, "text"), (4, "text"), (5, "text")]))
