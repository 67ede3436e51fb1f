"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

A word is a sequence of vocabulary pieces, drawn one by one; its probability in
a language is the sum over all its segmentations, which a forward pass over its
characters adds up. Piece probabilities come from one round of expectation-
maximisation: with starting probabilities that fall with a piece's rank in the
vocabulary, forward and backward passes give the expected count of each piece
in each language's text, over all rows that may be learned from.

Words are lower-cased and begin with the word mark, as in the vocabulary;
characters that no piece holds are spelled by byte pieces.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64
from specloom.llm.merge_dropout import MODEL, _model

MARK = 0x2581
# Expected counts are smoothed by so many draws from all languages' distribution.
SMOOTHING = 200.0
# Models beyond so many languages would no longer fit a broadcast of tens of MB.
MAX_LANGUAGES = 200
# Words up to so many characters need no rescaling: a factor of exp(BOOST) per character does.
PLAIN = 120
BOOST = 2.5
# Distinct words whose scores a task keeps.
KEPT_WORDS = 400_000


class Vocabulary:
    """Pieces by the hash of their characters."""

    def __init__(self, model: bytes):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = processor.get_piece_size()
        pieces, ids, self.byte_ids = [], [], np.zeros(256, np.int64)
        for i in range(n):
            if processor.is_byte(i):
                self.byte_ids[int(processor.id_to_piece(i)[3:5], 16)] = i
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                pieces.append(processor.id_to_piece(i))
                ids.append(i)
        self.size = n
        self.longest = max(map(len, pieces))
        codes = np.array([_code(p) for p in pieces], U64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], np.array(ids)[order]
        self.chars = np.zeros(0x110000, bool)
        self.chars[[ord(p) for p in pieces if len(p) == 1]] = True
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[codes >> U64(44)] = True
        # Beginnings of pieces: where none fits, no longer piece does.
        self.begins = np.zeros(1 << 22, bool)
        self.begins[np.array([_code(b) for b in {p[:k] for p in pieces for k in range(1, len(p) + 1)}], U64) >> U64(42)] = True
        rank = np.full(n, float(n))
        rank[ids] = np.arange(1, len(ids) + 1)
        start = 1.0 / (rank + 50.0)
        self.start = start / start.sum()

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Piece ids, or -1."""
        out = np.full(len(codes), -1)
        at = np.flatnonzero(self.maybe[codes >> U64(44)])
        place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        hit = self.codes[place] == codes[at]
        out[at[hit]] = self.ids[place[hit]]
        return out


def _code(piece: str) -> int:
    """The hash of a piece, as ``Words`` makes it step by step."""
    code = np.zeros(1, U64)
    for c in piece:
        code = K.mix(code + np.array([ord(c)], U64) + U64(1))
    return int(code[0])


@lru_cache(maxsize=2)
def vocabulary_of(model: bytes) -> Vocabulary:
    return Vocabulary(model)


class Texts:
    """The words of some texts: ``text`` and ``word`` of each occurrence, ``keys`` of the distinct words."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        size = np.array([len(t) + 1 for t in lowered])
        self.code = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        space = (self.code == 0x20) | ((self.code >= 0x09) & (self.code <= 0x0D))
        before = np.concatenate(([True], space[:-1]))
        start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        self.text = np.searchsorted(np.cumsum(size), start, "right")
        length = end - start
        self.keys, self.word = np.zeros(0, U64), np.zeros(0, np.int64)
        if len(start):
            weights = K.powers(int(length.max()))
            begin = np.cumsum(length) - length
            where = np.arange(int(length.sum())) + np.repeat(start - begin, length)
            values = K.mix(self.code[where].astype(U64) + U64(3)) * weights[where - np.repeat(start, length)]
            key = K.mix(np.add.reduceat(values, begin) + length.astype(U64))
            self.keys, first, self.word = np.unique(key, return_index=True, return_inverse=True)
            self.start, self.length = start[first], length[first]


class Words:
    """Distinct words ``which`` of some texts, longest first, and every piece that occurs in them.

    ``edge_*``: a piece ``id`` from character ``begin`` to ``end`` of a word.
    Byte-spelled characters are edges with ``bytes`` set.
    """

    def __init__(self, texts: Texts, which: np.ndarray, vocabulary: Vocabulary):
        self.count = len(which)
        if not self.count:
            return
        self.which = which[np.argsort(-texts.length[which], kind="stable")]
        start, length = texts.start[self.which], texts.length[self.which]
        self.length = length + 1
        # All characters of the distinct words, each word behind its mark.
        self.first = np.cumsum(self.length) - self.length
        chars = np.full(int(self.length.sum()), MARK, np.uint32)
        own = np.ones(len(chars), bool)
        own[self.first] = False
        body = np.cumsum(length) - length
        chars[own] = texts.code[np.arange(int(length.sum())) + np.repeat(start - body, length)]
        self._edges(chars, vocabulary)

    def _edges(self, chars, vocabulary):
        word = np.repeat(np.arange(self.count), self.length)
        place = np.arange(len(chars)) - self.first[word]
        room = self.length[word] - place
        words, begins, sizes, ids = [], [], [], []
        at, code = np.arange(len(chars)), np.zeros(len(chars), U64)
        for n in range(1, vocabulary.longest + 1):
            on = room[at] >= n
            at, code = at[on], code[on]
            if not len(at):
                break
            code = K.mix(code + chars[at + n - 1].astype(U64) + U64(1))
            on = vocabulary.begins[code >> U64(42)]
            at, code = at[on], code[on]
            found = vocabulary.find(code)
            hit = np.flatnonzero(found >= 0)
            words.append(word[at[hit]])
            begins.append(place[at[hit]])
            sizes.append(np.full(len(hit), n))
            ids.append(found[hit])
        self.lacking = np.flatnonzero(~vocabulary.chars[chars])
        words.append(word[self.lacking])
        begins.append(place[self.lacking])
        sizes.append(np.ones(len(self.lacking), np.int64))
        ids.append(np.full(len(self.lacking), -1))
        which = np.concatenate([np.full(sum(map(len, ids[:-1])), -1), np.arange(len(self.lacking))])
        self.spelled = [chr(c).encode("utf-8", "surrogatepass") for c in chars[self.lacking].tolist()]
        self.edge_word, self.edge_begin, self.edge_id = map(np.concatenate, (words, begins, ids))
        self.edge_end = self.edge_begin + np.concatenate(sizes)
        self.edge_bytes = which

    def edge_logs(self, log_p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """Log probability of each edge in each language (columns)."""
        out = log_p[np.maximum(self.edge_id, 0)]
        some = np.flatnonzero(self.edge_bytes >= 0)
        for i in some.tolist():
            out[i] = log_p[vocabulary.byte_ids[list(self.spelled[self.edge_bytes[i]])]].sum(axis=0)
        return out

    def forward(self, p: np.ndarray, backward: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all segmentations up to each place, as (scaled sums, log scale), per character border and language.

        ``backward``: from each place to the end of the word. The table has a
        row for each border of each word, the front first.
        """
        border = self.first + np.arange(self.count)
        table = np.zeros((int(self.length.sum()) + self.count, p.shape[1]))
        source, target = (self.edge_end, self.edge_begin) if backward else (self.edge_begin, self.edge_end)
        step = (self.length[self.edge_word] - target) if backward else target
        order = np.argsort(step * self.count + self.edge_word)
        step = step[order]
        row_from = (border[self.edge_word] + source)[order]
        row_to = (border[self.edge_word] + target)[order]
        table[border + self.length if backward else border] = 1.0
        cut = np.searchsorted(step, np.arange(1, int(self.length[0]) + 2))
        head = np.ones(len(row_to), bool)
        head[1:] = row_to[1:] != row_to[:-1]
        plain = int(self.length[0]) <= PLAIN
        # Short words: a constant factor per character keeps the sums in range.
        p = (p * np.exp(BOOST * (self.edge_end - self.edge_begin))[:, None] if plain else p)[order]
        scale = np.zeros(table.shape[0])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            first = np.flatnonzero(head[a:b])
            to, parts = row_to[a:b][first], table[row_from[a:b]] * p[a:b]
            if plain:
                table[to] = np.add.reduceat(parts, first, axis=0)
                continue
            # All sums into one place are brought to the largest of their scales.
            own = scale[row_from[a:b]]
            high = np.maximum.reduceat(own, first)
            factor = np.exp(own - np.repeat(high, np.diff(np.append(first, b - a))))
            total = np.add.reduceat(parts * factor[:, None], first, axis=0)
            top = np.maximum(total.max(axis=1), 1e-300)
            table[to], scale[to] = total / top[:, None], high + np.log(top)
        if plain:
            place = np.arange(len(scale)) - np.repeat(border, self.length + 1)
            scale = -BOOST * (np.repeat(self.length, self.length + 1) - place if backward else place)
        return table, scale

    def totals(self, p: np.ndarray) -> np.ndarray:
        """Log probability of each distinct word in each language."""
        table, scale = self.forward(p)
        end = self.first + np.arange(self.count) + self.length
        return np.log(np.maximum(table[end], 1e-300)) + scale[end][:, None]


def _expected(shared, languages: list[str]):
    """(language, part, counts): expected piece counts of a task, in pieces of 1,024."""

    def work(batches):
        vocabulary = vocabulary_of(shared.value)
        counts = np.zeros((len(languages), vocabulary.size))
        number = {x: i for i, x in enumerate(languages)}
        for part in K.text_slices(batches):
            texts = Texts(_strings(part.column("text")))
            words = Words(texts, np.arange(len(texts.keys)), vocabulary)
            if not words.count:
                continue
            language = np.array([number[x] for x in part.column("lang").to_pylist()])[texts.text]
            times = np.bincount(texts.word * len(languages) + language, minlength=words.count * len(languages))
            times = times.reshape(-1, len(languages))[words.which]
            log_p = np.log(vocabulary.start)[:, None]
            logs = words.edge_logs(log_p, vocabulary)
            p = np.exp(logs)
            ahead, ahead_scale = words.forward(p)
            behind, behind_scale = words.forward(p, backward=True)
            border = words.first + np.arange(words.count)
            end = (border + words.length)[words.edge_word]
            a, b = border[words.edge_word] + words.edge_begin, border[words.edge_word] + words.edge_end
            log_share = np.log(np.maximum(ahead[a, 0] * behind[b, 0], 1e-300)) + ahead_scale[a] + behind_scale[b] + logs[:, 0]
            share = np.exp(np.minimum(log_share - np.log(ahead[end, 0]) - ahead_scale[end], 0.0))
            plain = words.edge_id >= 0
            for i in range(len(languages)):
                weight = share * times[words.edge_word, i]
                counts[i] += np.bincount(words.edge_id[plain], weights=weight[plain], minlength=vocabulary.size)
                for e in np.flatnonzero(~plain & (weight > 0)).tolist():
                    np.add.at(counts[i], vocabulary.byte_ids[list(words.spelled[words.edge_bytes[e]])], weight[e])
        rows = [(x, k, counts[i, k : k + 1024]) for i, x in enumerate(languages) for k in range(0, vocabulary.size, 1024)]
        rows = [r for r in rows if r[2].any()]
        yield pa.RecordBatch.from_pydict(
            {
                "language": pa.array([x for x, _, _ in rows], pa.string()),
                "part": pa.array([k for _, k, _ in rows], pa.int32()),
                "counts": pa.array([c.tobytes() for _, _, c in rows], pa.binary()),
            }
        )

    return work


def _strings(column: pa.Array) -> list[str]:
    return [x.decode("utf-8", "replace") for x in column.cast(pa.binary()).fill_null(b"").to_pylist()]


def _added(key, table):
    total = np.sum([np.frombuffer(x.as_py()) for x in table.column("counts")], axis=0)
    return pa.table({"language": pa.array([key[0].as_py()], pa.string()), "part": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


class LanguageModel:
    """Log probabilities of all pieces (rows) in all languages (columns)."""

    def __init__(self, languages: list[str], counts: np.ndarray, start: np.ndarray):
        self.languages = languages
        shared = counts.sum(axis=0) + start
        shared /= shared.sum()
        smooth = counts + SMOOTHING * (0.5 * shared + 0.5 * start)
        self.log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T


def learn(documents: DataFrame, model: str = MODEL) -> LanguageModel:
    """Learn from all rows of (text, lang) with both; the model has a fixed size per language."""
    rows = documents.filter("text is not null and lang is not null").select("text", "lang")
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shared = _model(documents.sparkSession, model)
    vocabulary = vocabulary_of(shared.value)
    counts = np.zeros((len(languages), vocabulary.size))
    schema = "language string, part int, counts binary"
    found = rows.mapInArrow(_expected(shared, languages), schema).groupBy("language", "part").applyInArrow(_added, schema)
    for language, part, values in found.collect() if languages else []:  # a vocabulary per language, whatever the data
        counts[languages.index(language), part : part + 1024] = np.frombuffer(values)
    return LanguageModel(languages, counts, vocabulary.start)


def _predicted(shared, learned):
    def work(batches):
        vocabulary, model = vocabulary_of(shared.value), learned.value
        languages = len(model.languages)
        kept, kept_logs = np.zeros(0, U64), np.zeros((0, languages))
        for part in K.text_slices(batches):
            texts = Texts(_strings(part.column("text")))
            # Scores of words that the task has met before are at hand.
            place = np.searchsorted(kept, texts.keys)
            met = np.zeros(len(texts.keys), bool)
            met[place < len(kept)] = kept[place[place < len(kept)]] == texts.keys[place < len(kept)]
            logs = np.zeros((len(met), languages))
            logs[met] = kept_logs[place[met]]
            words = Words(texts, np.flatnonzero(~met), vocabulary)
            if words.count:
                logs[words.which] = words.totals(np.exp(words.edge_logs(model.log_p, vocabulary)))
                if len(kept) < KEPT_WORDS:
                    kept, kept_logs = np.concatenate((kept, texts.keys[~met])), np.concatenate((kept_logs, logs[~met]))
                    order = np.argsort(kept)
                    kept, kept_logs = kept[order], kept_logs[order]
            scores = np.zeros((part.num_rows, languages))
            for i in range(languages):
                scores[:, i] = np.bincount(texts.text, weights=logs[texts.word, i], minlength=part.num_rows)
            known = np.array(part.column("known").to_pylist(), bool)
            best = scores.argmax(axis=1)
            share = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "lang_pred": pa.array([model.languages[b] if k else "und" for b, k in zip(best, known)], pa.string()),
                    "score": pa.array(np.where(known, share, 0.0)),
                }
            )

    return work


def held_out() -> F.Column:
    """Rows whose language is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify_languages(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``documents`` (doc_id, text, lang, ...).

    Learns from text and lang of all rows that aren't held out and have both. ``score`` is
    the probability of the predicted language, with equal shares beforehand.
    Texts that are null or have no letter are ``und`` with score 0, and so is
    every text if nothing can be learned. Equal scores go to the first language by name. Rows without a
    doc_id aren't held out. Repeated rows count as often as they come.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    learned = learn(docs.filter(~held_out()), model)
    if not learned.languages:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    spark = documents.sparkSession
    shared, learned = _model(spark, model), spark.sparkContext.broadcast(learned)
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = docs.select("doc_id", "text", known.alias("known")).mapInArrow(
        _predicted(shared, learned), "doc_id long, lang_pred string, score double"
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
