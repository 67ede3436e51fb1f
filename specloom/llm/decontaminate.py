"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Every n-gram of the test items is a seed, however frequent: which n-grams
   a partial or edited copy keeps can't be told from how often they occur.
2. Seeds join documents to items. A place is left out only if no alignment
   there can score enough: a word that the item has adds 2 at most, any other
   takes 1, and the best stretch of such words bounds the score.
3. Around the hits that are left, the words of the document are aligned with
   the item's by Smith-Waterman, so edited and paraphrased copies score too: a
   match counts 2, a mismatch or gap -1.

The test items go in blocks of bounded size to the executors; the documents are
read where they lie and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64

GRAM = 3
# Share of the best possible score, or of words in a row, that counts as a copy.
SHARE = 0.4
LONG_COPY = 40
# Words that a copy has at least (or four fifths of a shorter item): a few in a row can be chance.
LEAST_WORDS = 10
# Text of test items in one block, in bytes.
BLOCK_BYTES = 16_000_000
MATCH, OTHER = 2, -1
# Hits, or words around hits, that are looked at together; a document's hits stay together.
PART = 500_000

_word_byte = np.zeros(256, bool)
_word_byte[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of letters and digits, A-Z lower-cased."""
    data, offsets = K.text_buffer(column)
    data = K.LOWER[data]
    starts, ends, doc = K._spans(_word_byte[data], offsets)
    return K.span_hashes(data, starts, ends), doc


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and where in ``words`` it ends."""
    best, end = 0, 0
    steps = np.arange(len(words))
    row = np.zeros(len(words) + 1, np.int64)
    for w in item:
        new = row[:-1] + np.where(words == w, MATCH, OTHER)
        np.maximum(new, row[1:] + OTHER, out=new)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - OTHER * steps) + OTHER * steps  # gaps in the item
        row[1:] = new
        at = int(new.argmax())
        if new[at] > best:
            best, end = int(new[at]), at + 1
    return best, end


class Seeds:
    """The n-grams of a block of items: which items have them, and where."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.ids = [i for i, _ in items]
        hashes, doc = word_hashes(pa.array([t for _, t in items], pa.string()))
        cut = np.searchsorted(doc, np.arange(len(items) + 1))
        self.words = [hashes[a:b] for a, b in zip(cut[:-1], cut[1:])]
        ok = np.flatnonzero(K.same_text(doc, n))
        gram = K.ngram_hashes(hashes, n)[ok]
        self.item, self.at = doc[ok], ok - cut[doc[ok]]
        order = np.argsort(gram, kind="stable")
        self.item, self.at = self.item[order], self.at[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.length = np.diff(np.append(self.first, len(self.item)))
        bits = max(16, (8 * max(len(self.gram), 1) - 1).bit_length())
        self.shift = U64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.gram >> self.shift] = True
        # (item, word) of all items, to ask whether an item has a word.
        self.has = np.unique(K.mix(hashes + K.mix(doc.astype(U64))))
        self.size = np.diff(cut)

    def hits(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``gram`` that are seeds, and which."""
        if not len(self.gram):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.maybe[gram >> self.shift])
        seed = np.minimum(np.searchsorted(self.gram, gram[at]), len(self.gram) - 1)
        hit = self.gram[seed] == gram[at]
        return at[hit], seed[hit]


def _grams(column: pa.Array, n: int):
    hashes, doc = word_hashes(column)
    ok = K.same_text(doc, n)
    return hashes, doc, K.ngram_hashes(hashes, n), ok


def _parts(sizes: np.ndarray, limit: int = PART):
    """Cuts between which ``sizes`` add up to about ``limit``."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = total[at] - sizes[at]
        to = max(int(np.searchsorted(total, base + limit, "right")), at + 1)
        yield at, to
        at = to


def _bounds(hashes: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, seeds: Seeds) -> np.ndarray:
    """For each region of a document, a score that no alignment with its item exceeds."""
    out = np.zeros(len(item), np.int64)
    length = high - low
    for a, b in _parts(length):
        n = length[a:b]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(low[a:b] - first, n)
        key = K.mix(hashes[at] + np.repeat(K.mix(item[a:b].astype(U64)), n))
        found = seeds.has[np.minimum(np.searchsorted(seeds.has, key), len(seeds.has) - 1)] == key
        total = np.concatenate(([0], np.cumsum(np.where(found, MATCH, OTHER))))
        # The smallest sum so far within the region: regions are set apart by a step longer than any sum.
        apart = np.repeat(np.arange(b - a), n) * np.int64(2**33)
        smallest = np.minimum.accumulate(total[:-1] - apart) + apart
        out[a:b] = np.maximum(np.maximum.reduceat(total[1:] - smallest, first), 0)
    return out


def _copies(part: pa.RecordBatch, seeds: Seeds, n: int, share: float, long_copy: int) -> dict:
    """(row, item): score and place of the best copy, for the rows of a slice that have one."""
    hashes, doc, gram, ok = _grams(part.column("text"), n)
    at, seed = seeds.hits(gram)
    at, seed = at[ok[at]], seed[ok[at]]
    cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    rows, times = K.runs(doc[at])
    hits = np.add.reduceat(seeds.length[seed], rows) if len(rows) else rows
    ends = rows + times
    for a, b in _parts(hits):
        own = slice(rows[a], ends[b - 1])
        _found_in(found, hashes, doc, cut, at[own], seed[own], seeds, n, share, long_copy)
    return found


def _found_in(found: dict, hashes, doc, cut, at, seed, seeds: Seeds, n: int, share: float, long_copy: int) -> None:
    # Each hit with every item that has the seed, and where the item would begin.
    times = seeds.length[seed]
    at = np.repeat(at, times)
    begin = np.cumsum(times) - times
    place = np.arange(int(times.sum())) - np.repeat(begin, times) + np.repeat(seeds.first[seed], times)
    item, start = seeds.item[place], at - seeds.at[place]
    order = np.lexsort((start, item, doc[at]))
    row, item, start = doc[at][order], item[order], start[order]
    size = seeds.size[item]
    head = np.ones(len(row), bool)
    # Hits whose beginnings lie within an item's length are looked at together.
    head[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > size[1:])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(row)) - 1
    row, item, size = row[first], item[first], size[first]
    margin = size // 2 + n
    low = np.maximum(start[first] - margin, cut[row])
    high = np.minimum(start[last] + size + margin, cut[row + 1])
    least = MATCH * np.minimum(np.maximum(share * size, np.minimum(LEAST_WORDS, 0.8 * size)), long_copy)
    for g in np.flatnonzero(_bounds(hashes, item, low, high, seeds) >= least).tolist():
        r, i, begin = int(row[g]), int(item[g]), int(low[g])
        words, region = seeds.words[i], hashes[begin : int(high[g])]
        score, end = align(words, region)
        if score >= least[g]:
            back, length = align(words[::-1], region[:end][::-1])
            if score > found.get((r, i), (-1,))[0]:
                found[r, i] = score, begin + end - length - int(cut[r]), begin + end - int(cut[r])


def _aligned(shared, n: int, share: float, long_copy: int):
    def work(batches):
        seeds = shared.value
        for part in K.text_slices(batches):
            found = _copies(part, seeds, n, share, long_copy)
            if found:
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").take(pa.array([r for r, _ in found])),
                        "item_id": pa.array([seeds.ids[i] for _, i in found], pa.int64()),
                        "score": pa.array([s / (MATCH * len(seeds.words[i])) for (_, i), (s, _, _) in found.items()], pa.float64()),
                        "first_word": pa.array([a for _, a, _ in found.values()], pa.int64()),
                        "end_word": pa.array([b for _, _, b in found.values()], pa.int64()),
                    }
                )

    return work


def _clean(shared, n: int, share: float, long_copy: int):
    def work(batches):
        seeds = shared.value
        for part in K.text_slices(batches):
            keep = np.ones(part.num_rows, bool)
            keep[[r for r, _ in _copies(part, seeds, n, share, long_copy)]] = False
            yield part.filter(pa.array(keep))

    return work


COPIES = "doc_id long, item_id long, score double, first_word long, end_word long"


def benchmark_copies(
    documents: DataFrame, benchmark: DataFrame, gram: int = GRAM, share: float = SHARE, long_copy: int = LONG_COPY
) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): documents with a copy of a test item, and its best place.

    A copy is an alignment with at least ``share`` of the score of the whole
    item (and that of ``LEAST_WORDS`` words in a row), or that of
    ``long_copy`` words in a row. Words are runs of letters
    and digits. Null texts and items, and items of fewer than ``gram`` words,
    match nothing. Rows without a doc_id come out with null. Rows that repeat
    come out as often. Each item of a repeated item_id counts on its own.
    Other columns are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.filter("text is not null")
    found = documents.sparkSession.createDataFrame([], COPIES)
    for seeds in _seed_blocks(docs, benchmark, gram):
        found = found.unionByName(docs.mapInArrow(_aligned(seeds, gram, share, long_copy), COPIES))
    return found


def without_copies(
    documents: DataFrame, benchmark: DataFrame, gram: int = GRAM, share: float = SHARE, long_copy: int = LONG_COPY
) -> DataFrame:
    """The rows of ``documents``, with all their columns, that have no copy of a test item."""
    for seeds in _seed_blocks(documents, benchmark, gram):
        rows = documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
        documents = rows.mapInArrow(_clean(seeds, gram, share, long_copy), rows.schema).select("row.*")
    return documents


def _seed_blocks(docs: DataFrame, benchmark: DataFrame, gram: int) -> list:
    """The seeds of each block of test items, for the executors."""
    context = docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // BLOCK_BYTES)
    out = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        out.append(context.broadcast(Seeds([tuple(r) for r in own.collect()], gram)))
    return out
