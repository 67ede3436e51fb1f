"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: hashes of words and of the beginnings of words (so
inflected forms count) that mark toxic texts among labelled ones. Lexicon
densities, second-person pronouns near lexicon words, capitals, punctuation
and obfuscation (words that are in the lexicon once digits and signs are read
as the letters they stand for) are the features of a text. Spark ML fits the
trees on them and, on other rows, an isotonic calibration of their margin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64
from specloom.session import materialise

# Labelled rows that the classifier is fitted on, at most: of each label those with the
# smallest hashes, toxic ones up to half.
FIT_ROWS = 24_000
# Rows of each label that trees need; with fewer the lexicon scores.
TREE_ROWS = 5
# Entries of the lexicon, at most, and labelled texts that an entry must be in.
LEXICON_ENTRIES = 4_000
LEXICON_TEXTS = 3
# Log odds from which an entry counts as strong.
STRONG = 5.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
# Second-person pronouns of English, German, French and Spanish: fixed values.
PRONOUNS = "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta vous votre tú ti usted ustedes vosotros"
NEAR = 5
# What digits and signs stand for in disguised words: fixed values.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FEATURES = [
    "lexicon_share", "lexicon_words", "lexicon_best", "prefix_share", "prefix_words", "prefix_best", "near_pronouns", "pronoun_share",
    "capital_share", "shouted_share", "mark_share", "exclamation_share", "disguised_share", "disguised_words", "log_words", "repeated_share",
    "strong_words", "strong_sum",
]

_letter = np.zeros(256, bool)
_letter[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_upper = np.zeros(256, bool)
_upper[0x41:0x5B] = True
_mark = np.zeros(256, bool)
_mark[[*b"!?.,;:-_*#%&$@\"'()[]{}<>/\\|~^+="]] = True
_plain = K.LOWER.copy()
for _sign, _stands_for in DISGUISES.items():
    _plain[ord(_sign)] = ord(_stands_for)
_in_disguise = np.zeros(256, bool)
_in_disguise[[ord(x) for x in DISGUISES]] = True


def _core_spans(data, starts, ends):
    """Words without the other signs at their ends."""
    inside = _letter[data] | ((data >= 0x30) & (data <= 0x39)) | (data == 0x24) | (data == 0x40)
    place = np.arange(len(data))
    after = np.minimum.accumulate(np.where(inside, place, len(data))[::-1])[::-1] if len(data) else place
    before = np.maximum.accumulate(np.where(inside, place, -1))
    first = np.minimum(after[starts], ends)
    last = np.maximum(before[ends - 1] + 1, first)
    return first, last


def word_codes(part: pa.RecordBatch):
    """Word number, text and hashes of each text's words, whole and their beginnings, plain and undisguised."""
    data, offsets = K.text_buffer(part.column("text"))
    starts, ends, doc = K.word_spans(data, offsets)
    first, last = _core_spans(data, starts, ends)
    some = last > first
    first, last, core_doc = first[some], last[some], doc[some]
    low = K.LOWER[data]
    whole = K.span_hashes(low, first, last)
    # Beginnings of words that are longer; marked by their length, so no whole word equals them.
    begin = []
    for n in PREFIXES:
        code = K.span_hashes(low, first, np.minimum(last, first + n))
        begin.append(np.where(last - first >= n, K.mix(code + U64(n)), U64(0)))
    return data, offsets, doc, first, last, core_doc, whole, begin


def _counted(batches):
    """(code, toxic, clean): in how many labelled texts of a task each word or beginning is."""
    found = []
    for part in K.text_slices(batches):
        *_, doc, whole, begin = word_codes(part)
        label = np.array(part.column("label").to_pylist(), np.int64)
        code = np.concatenate([whole, *begin])
        pairs = np.unique(np.stack([code, np.tile(doc, 1 + len(begin)).astype(U64)]), axis=1) if len(code) else None
        if pairs is not None:
            code, toxic = pairs[0], label[pairs[1].astype(np.int64)]
            first, length = K.runs(code)
            hits = np.add.reduceat(toxic, first)
            found.append((code[first], hits, length - hits))
    if found:
        code, toxic, clean = (np.concatenate(x) for x in zip(*found))
        code, inverse = np.unique(code, return_inverse=True)
        toxic, clean = (np.bincount(inverse, weights=x).astype(np.int64) for x in (toxic, clean))
        some = code > 0
        yield pa.RecordBatch.from_pydict(
            {"code": pa.array(K.as_long(code[some])), "toxic": pa.array(toxic[some]), "clean": pa.array(clean[some])}
        )


class Lexicon:
    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.weights = codes[order], weights[order]
        self.pronouns = np.sort(K.span_hashes(*_spans_of(PRONOUNS.split())))

    def weight(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.weights[at], 0.0)


def _spans_of(words: list[str]):
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.frombuffer(b"".join(raw), np.uint8), ends - np.array([len(w) for w in raw]), ends


def features(part: pa.RecordBatch, lexicon: Lexicon) -> np.ndarray:
    """The features of each text of a slice; of an empty or null text they are zero."""
    data, offsets, all_doc, first, last, doc, whole, begin = word_codes(part)
    n = part.num_rows
    per_doc = lambda values: np.bincount(doc, weights=values, minlength=n)
    best_of = lambda values: _best(values, doc, n)
    words = np.maximum(np.bincount(all_doc, minlength=n), 1)
    n_bytes = np.maximum(np.diff(offsets), 1)
    weight = lexicon.weight(whole)
    prefix = np.maximum.reduce([np.zeros(len(whole)), *(lexicon.weight(b) for b in begin)])
    hit, strong = np.maximum(weight, prefix) > 0, np.maximum(weight, prefix) >= STRONG
    pronoun = lexicon.pronouns[np.minimum(np.searchsorted(lexicon.pronouns, whole), len(lexicon.pronouns) - 1)] == whole
    reach = np.cumsum(np.concatenate(([0], pronoun)))
    place = np.arange(len(whole))
    n_cores = np.bincount(doc, minlength=n)
    after = np.cumsum(n_cores)
    low, high = np.maximum(place - NEAR, (after - n_cores)[doc]), np.minimum(place + NEAR + 1, after[doc])
    near = hit & (reach[high] > reach[low])
    # Words with signs or digits among letters, read as the letters that they stand for.
    signs = np.cumsum(np.concatenate(([0], _in_disguise[data])))
    letters = np.cumsum(np.concatenate(([0], _letter[data])))
    mixed = (signs[last] > signs[first]) & (letters[last] - letters[first] >= 2) & (last - first <= 32)
    undisguised = np.zeros(len(whole), bool)
    if mixed.any():
        plain = _plain[data]
        code = K.span_hashes(plain, first[mixed], last[mixed])
        undisguised[mixed] = (lexicon.weight(code) > 0) & ~hit[mixed]
    capitals = np.cumsum(np.concatenate(([0], _upper[data])))
    shouted = (capitals[last] - capitals[first] >= 2) & (capitals[last] - capitals[first] == last - first)
    span = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[data])))[offsets])
    exclaim = np.zeros(256, bool)
    exclaim[[0x21, 0x3F]] = True
    again = np.zeros(len(whole), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (doc[1:] == doc[:-1])
    return np.stack(
        [
            per_doc(weight > 0) / words, per_doc(weight > 0), best_of(weight), per_doc(prefix > 0) / words, per_doc(prefix > 0), best_of(prefix),
            per_doc(near), per_doc(pronoun) / words, span(_upper) / n_bytes, per_doc(shouted) / words, span(_mark) / n_bytes,
            span(exclaim) / n_bytes, per_doc(mixed) / words, per_doc(undisguised), np.log1p(np.bincount(all_doc, minlength=n)),
            per_doc(again) / words, per_doc(strong), per_doc(np.where(strong, np.maximum(weight, prefix), 0.0)),
        ],
        axis=1,
    )


def _best(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    if len(values):
        first = K.runs(doc)[0]
        out[doc[first]] = np.maximum.reduceat(values, first)
    return out


def _featured(shared, keep: list[str]):
    def work(batches):
        for part in K.text_slices(batches):
            values = features(part, shared.value)
            offsets = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
            columns = {c: part.column(c) for c in keep} | {"features": pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))}
            yield pa.RecordBatch.from_pydict(columns)

    return work


def learn_lexicon(labelled: DataFrame, entries: int = LEXICON_ENTRIES) -> Lexicon:
    """The codes that mark toxic texts best, of (text, label)."""
    n_toxic, n_clean = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("label")), F.lit(0))).first()
    counted = labelled.mapInArrow(_counted, "code long, toxic long, clean long")
    counted = counted.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    best = (
        counted.filter(f"toxic >= {LEXICON_TEXTS}")
        .withColumn("weight", odds)
        .filter("weight > 2.5")
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "code")
        .limit(entries)
        .select("code", "weight")
        .collect()
    )
    return Lexicon(np.array([r[0] for r in best], np.int64).view(U64), np.array([r[1] for r in best], float))


def fit_sample(labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, weight) of at most ``fit_rows`` rows, and how many rows each label has.

    Toxic rows are taken first, up to half, so rare ones aren't missed; a row's weight is how many of
    its label it stands for. Chosen by id alone; so few that every executor can know them.
    """
    known = labels.filter("label in (0, 1) and doc_id is not null")
    total = {0: 0, 1: 0} | dict(known.groupBy(F.col("label").cast("int")).count().collect())
    room = {1: fit_rows // 2}
    room[0] = fit_rows - min(total[1], room[1])
    order = F.xxhash64(F.col("doc_id"), F.lit("fit"))
    parts = [
        known.filter(F.col("label") == label)
        .orderBy(order, "doc_id")
        .limit(room[label])
        .withColumn("weight", F.lit(max(total[label] / max(room[label], 1), 1.0)))
        for label in (0, 1)
    ]
    return parts[0].unionByName(parts[1]), total


class Toxicity:
    """The fitted lexicon, trees and calibration.

    Where too few labels of a kind are left for trees, the lexicon alone
    scores: odds of the labels times those of the strong words. Without labels of both kinds the score is constant.
    """

    def __init__(self, documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
        """Fit on the texts of (doc_id, text) that ``fit_sample`` takes of (doc_id, label)."""
        spark = documents.sparkSession
        chosen, total = fit_sample(labels, fit_rows)
        # One text of a repeated id, and always the same one.
        rows = documents.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "label", "weight")).alias("row"))
        fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(10))
        rows = materialise(rows.select("doc_id", "row.*", fold.alias("fold")), "toxicity-fit")
        self.trees = self.calibration = None
        self.base = total[1] / max(sum(total.values()), 1)
        counts = {0: 0, 1: 0} | dict(rows.filter("fold >= 4").groupBy(F.col("label").cast("int")).count().collect())
        enough = min(counts.values()) >= TREE_ROWS
        # Trees must not see the texts that the lexicon was learned from; without trees it learns from all.
        learned = rows.filter("fold < 4") if enough else rows
        lexicon = learn_lexicon(learned.select("text", F.col("label").cast("long").alias("label")))
        self.lexicon = spark.sparkContext.broadcast(lexicon)
        if not enough:
            return
        table = materialise(self._vectors(rows.filter("fold >= 4"), ["label", "weight", "fold"]).coalesce(4), "toxicity-features")
        table = table.withColumn("label", F.col("label").cast("double")).withColumn("features", array_to_vector("features"))
        trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight")
        self.trees = trees.fit(table.filter("fold < 8"))
        margins = self._margins(table.filter("fold >= 8")).select("label", "weight", "margin")
        if margins.select("label").distinct().count() == 2:
            self.calibration = IsotonicRegression(featuresCol="margin", weightCol="weight").fit(margins)

    def _vectors(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        schema = StructType([*(docs.schema[c] for c in keep), StructField("features", ArrayType(DoubleType()))])
        return docs.select(*keep, "text").mapInArrow(_featured(self.lexicon, keep), schema)

    def _margins(self, table: DataFrame) -> DataFrame:
        scored = self.trees.transform(table).withColumn("margin", vector_to_array("rawPrediction")[1])
        return scored.drop("rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame, key: str = "doc_id") -> DataFrame:
        """(key, score, features) of every row of (key, text); score is between 0 and 1."""
        table = self._vectors(docs, [key])
        if self.trees is None:
            if not 0 < self.base < 1:
                return table.select(key, F.lit(float(self.base)).alias("score"), "features")
            odds = F.lit(float(np.log(self.base / (1 - self.base)))) + F.get("features", F.lit(FEATURES.index("strong_sum")))
            return table.select(key, (1 / (1 + F.exp(-odds))).alias("score"), "features")
        table = self._margins(table.withColumn("given", F.col("features")).withColumn("features", array_to_vector("given")))
        # Calibration maps stretches of margins to one value; the margin tells them apart a little.
        share = 1 / (1 + F.exp(-2 * F.col("margin")))
        if self.calibration is None:
            return table.select(key, share.alias("score"), F.col("given").alias("features"))
        table = self.calibration.transform(table)
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("prediction") + 0.02 * share))
        return table.select(key, score.alias("score"), F.col("given").alias("features"))


def held_out() -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fitted(documents: DataFrame, labels: DataFrame) -> Toxicity:
    """The model learned from the labels of rows that aren't held out."""
    docs = _texts(documents)
    known = labels.filter("toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("label"))
    known = known.filter(~held_out())
    return Toxicity(docs.filter(~held_out()), known)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, features) for each row of ``documents`` (doc_id, text, ...).

    Learns from ``labels`` (doc_id, toxic) of rows that aren't held out: a
    sample of at most ``FIT_ROWS`` of them, the same on every run, toxic ones
    first. With fewer than ``TREE_ROWS`` rows of a label beside those that the
    lexicon learns from, the lexicon's strong words alone decide. Null and
    empty texts are scored like any other, by features that are zero. Rows
    without a doc_id are scored and not held out. A doc_id with several labels
    counts as toxic if one says so; other labels than 0 and 1 are left out.
    Without labels of both kinds the score is the share of toxic labels.
    """
    model = fitted(documents, labels)
    return model.score(_texts(documents)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "features"
    )


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, with all their columns, that ``toxicity`` doesn't reject."""
    model = fitted(documents, labels)
    rows = documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return model.score(rows, "row").filter(F.col("score") < threshold).select("row.*")
