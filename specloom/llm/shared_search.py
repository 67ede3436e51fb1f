"""Ranked lexical search of many items at once, by common subexpressions of their scores.

An item's score of a document is a sum over the item's terms, and items share
terms. Sums that several items have in common are computed once:

1. Documents are tokenised once; an index holds each one's distinct terms and
   how often they occur.
2. Items with the same terms are one query. Queries are laid out by likeness and
   cut into blocks of at most ``BLOCK_TERMS`` terms. In each block the term sets
   that queries share are mined, two at a time, the most shared first: a pair
   of terms or earlier pairs, held by two queries or more, becomes a node. The
   nodes form a graph from terms to queries that shares all sub-sums.
3. For each block, document frequencies are counted over the index. Then each
   task scores its documents: it fills in one accumulator per term, adds up one
   per node, each from two earlier ones, and sums a query's few nodes.
4. A task hands on the best documents it saw for each query; Spark ranks these.

Whatever is broadcast belongs to one block at a time, whose size is bounded (but
for a single item with more terms). Terms are compared by 64-bit hashes, so results are exact up to
collisions of these.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from specloom.llm import textkernel as K
from specloom.session import materialise, new_path

BEST = 10
BLOCK_TERMS = 20_000
# Accumulators of a task: documents are scored in slices so that they take about this much.
ACCUMULATOR_BYTES = 24_000_000
# A query's pairs are mined among neighbours of this distance, when its parts are laid out by how many queries share them.
REACH = 24

# Terms are runs of digits, letters and all that isn't ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NO_ID = np.iinfo(np.int64).max


# Terms


def _term_hashes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of the texts, in order, and the place of its text."""
    data, offsets = K.text_buffer(part.column("text"))
    starts, ends, text = K._spans(IS_TERM[data], offsets)
    return K.as_long(K.span_hashes(K.LOWER[data], starts, ends)), text


def _cut(values: np.ndarray, text: np.ndarray, n: int) -> list[bytes]:
    """Values that belong to texts 0 to n - 1, ascending, as bytes by text."""
    at = np.searchsorted(text, np.arange(n + 1))
    return [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


def _counted(batches):
    """(id, n, terms, counts): the distinct terms of each text by rising hash, and their occurrences."""
    for part in K.text_slices(batches):
        hashes, text = _term_hashes(part)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(hashes))).astype(np.int32)
        n = part.num_rows
        yield pa.RecordBatch.from_pydict(
            {
                "id": part.column("id"),
                "n": pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                "terms": pa.array(_cut(hashes[first], text[first], n), pa.binary()),
                "counts": pa.array(_cut(counts, text[first], n), pa.binary()),
            }
        )


def term_counts(rows: DataFrame) -> DataFrame:
    """(id, n, terms, counts) of (id, text); hashes and counts as packed little-endian integers of 64 and 32 bits."""
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_counted, f"id {kind}, n long, terms binary, counts binary")


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of the packed rows, and how many each row has."""
    data, offsets = K.text_buffer(column)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


# Plans


@dataclass(frozen=True)
class Plan:
    """A block's graph. Parts 0 to len(terms) - 1 are terms, the others nodes, each the sum of two earlier parts."""

    terms: np.ndarray  # hashes, rising
    nodes: np.ndarray  # (n, 2)
    tops: list[np.ndarray]  # of each query: the parts to sum up

    @property
    def n_parts(self) -> int:
        return len(self.terms) + len(self.nodes)


def mined(queries: list[np.ndarray]) -> Plan:
    """The plan for queries, given as hashes with repeats.

    A term that a query has k times is k different items of its set, so a
    repeat is shared by the queries that have as many.
    """
    terms = np.unique(np.concatenate([np.zeros(0, np.int64), *queries]))
    name, term_of, sets = {}, [], []  # an item (term, repeat) gets a number
    for q in queries:
        own, seen = [], Counter()
        for t in np.searchsorted(terms, np.sort(q)).tolist():
            key = (t, seen[t])
            seen[t] += 1
            if key not in name:
                name[key] = len(term_of)
                term_of.append(t)
            own.append(name[key])
        sets.append(own)
    children: list[tuple[int, int]] = []
    while True:
        held = Counter(x for own in sets for x in own)
        laid = [sorted((x for x in own if held[x] > 1), key=lambda x: (-held[x], x)) for own in sets]
        pairs = Counter((min(x, y), max(x, y)) for own in laid for i, x in enumerate(own) for y in own[i + 1 : i + 1 + REACH])
        shared = {p: c for p, c in pairs.items() if c > 1}
        if not shared:
            break
        found: dict[tuple[int, int], list[tuple[int, set]]] = {}
        for k, own in enumerate(laid):
            here = [(min(x, y), max(x, y)) for i, x in enumerate(own) for y in own[i + 1 : i + 1 + REACH]]
            taken: set[int] = set()
            for p in sorted((p for p in here if p in shared), key=lambda p: (-shared[p], p)):
                if p[0] not in taken and p[1] not in taken:
                    taken.update(p)
                    found.setdefault(p, []).append(k)
        found = {p: ks for p, ks in found.items() if len(ks) > 1}
        if not found:  # each query prefers other pairs: take the most shared one
            p = min(shared, key=lambda p: (-shared[p], p))
            found = {p: [k for k, own in enumerate(laid) if p[0] in own and p[1] in own]}
        for p in sorted(found):
            node = len(term_of) + len(children)
            children.append(p)
            for k in found[p]:
                sets[k] = [x for x in sets[k] if x not in p] + [node]
    # Items stand for their terms, so items become terms, and nodes are numbered after the terms.
    part = lambda x: term_of[x] if x < len(term_of) else len(terms) + x - len(term_of)
    nodes = np.array([[part(a), part(b)] for a, b in children], np.int64).reshape(-1, 2)
    return Plan(terms, nodes, [np.array([part(x) for x in own], np.int64) for own in sets])


PLAN_ROW = "queries array<string>, terms binary, nodes binary, tops binary, sizes array<int>"


def _planned(limit: int):
    """The queries of one group to plans of at most ``limit`` terms each."""

    def row(names, queries):
        plan = mined(queries)
        tops = np.concatenate(plan.tops)
        return {"queries": names, "terms": plan.terms.tobytes(), "nodes": plan.nodes.tobytes(), "tops": tops.tobytes(), "sizes": [len(t) for t in plan.tops]}

    def work(group: pa.Table) -> pa.Table:
        rows, names, queries, size = [], [], [], 0
        for name, terms, counts in sorted(zip(*(group.column(c).to_pylist() for c in ("query", "terms", "counts")))):
            own = np.repeat(np.frombuffer(terms, np.int64), np.frombuffer(counts, np.int32))
            if names and size + len(own) > limit:
                rows.append(row(names, queries))
                names, queries, size = [], [], 0
            names.append(name)
            queries.append(own)
            size += len(own)
        rows.append(row(names, queries))
        return pa.Table.from_pylist(rows, pa.schema([("queries", pa.list_(pa.string())), ("terms", pa.binary()), ("nodes", pa.binary()), ("tops", pa.binary()), ("sizes", pa.list_(pa.int32()))]))

    return work


def _in_blocks(queries: DataFrame, n_blocks: int) -> DataFrame:
    """``queries`` with a ``block``: those that share their smallest hash, and so are likely to share terms, are dealt to few."""
    bits = lambda of, n: F.shiftrightunsigned(F.xxhash64(of), 64 - n)
    # Below the smallest hash, the query's own: queries that begin alike, however many, still spread. 52 bits fit a double.
    laid = queries.withColumn("like", (F.shiftleft(bits(F.substring("terms", 1, 8), 32), 20) + bits("query", 20)).cast("double"))
    edges = laid.approxQuantile("like", [k / n_blocks for k in range(1, n_blocks)], 0.1 / n_blocks) if n_blocks > 1 else []
    below = F.filter(F.lit(edges).cast("array<double>"), lambda e: e <= F.col("like")) if edges else F.array()
    return laid.withColumn("block", F.size(below))


def _plan(row) -> Plan:
    tops = np.split(np.frombuffer(row.tops, np.int64), np.cumsum(row.sizes)[:-1])
    return Plan(np.frombuffer(row.terms, np.int64), np.frombuffer(row.nodes, np.int64).reshape(-1, 2), tops)


# Scores


def _found(batch: pa.RecordBatch, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of a batch of the index, for ``terms`` only."""
    hashes, sizes = _unpacked(batch.column("terms"), np.int64)
    counts = _unpacked(batch.column("counts"), np.int32)[0]
    at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
    hit = terms[at] == hashes
    return np.repeat(np.arange(batch.num_rows), sizes)[hit], at[hit], counts[hit].astype(np.int64)


def _frequencies(plan):
    def work(batches):
        total = None
        for batch in batches:
            found = np.bincount(_found(batch, plan.value.terms)[1], minlength=len(plan.value.terms))
            total = found if total is None else total + found
        if total is not None:
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"term": pa.array(held.astype(np.int32)), "df": pa.array(total[held].astype(np.int64))})

    return work


def weights(n_documents: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))), one logarithm at a time, as the C library rounds it."""
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def accumulated(plan: Plan, values: np.ndarray) -> np.ndarray:
    """The scores, queries x documents, from what each term adds to each document, terms x documents."""
    parts = np.empty((plan.n_parts, values.shape[1]), np.int64)
    parts[: len(values)] = values
    for k, (a, b) in enumerate(plan.nodes.tolist(), len(values)):
        np.add(parts[a], parts[b], out=parts[k])
    return np.stack([parts[top].sum(axis=0) for top in plan.tops])


class _Best:
    """The best documents of each query so far: highest score, then smallest id."""

    def __init__(self, n_queries: int, best: int):
        self.best, self.query, self.score, self.id = best, *(np.zeros(0, np.int64) for _ in range(3))
        self.worst, self.worst_id = np.ones(n_queries, np.int64), np.full(n_queries, NO_ID)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        over, tie = scores > self.worst[:, None], scores == self.worst[:, None]
        query, doc = np.nonzero(over | (tie & (ids[None, :] <= self.worst_id[:, None])))
        if not len(query):
            return
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, scores[query, doc]), (self.id, ids[doc])))
        order = np.lexsort((ids, -score, query))
        first, length = K.runs(query[order])
        rank = np.arange(len(order)) - np.repeat(first, length)
        order = order[rank < self.best]
        self.query, self.score, self.id = query[order], score[order], ids[order]
        first, length = K.runs(self.query)
        full = first[length == self.best] + self.best - 1
        self.worst[self.query[full]], self.worst_id[self.query[full]] = self.score[full], self.id[full]


def _scored(plan, weight, n_documents: int, n_terms: int, best: int):
    def work(batches):
        p, w, top = plan.value, weight.value, None
        step = max(ACCUMULATOR_BYTES // (8 * (p.n_parts + len(p.tops))), 1)
        for batch in batches:
            top = top or _Best(len(p.tops), best)
            ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            m = 25 + (75 * batch.column("n").to_numpy() * n_documents) // n_terms
            doc, term, tf = _found(batch, p.terms)
            value = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            some = np.unique(doc)  # documents without any term of the block score nothing
            for at in range(0, len(some), step):
                here = some[at : at + step]
                a, b = np.searchsorted(doc, (here[0], here[-1] + 1))
                values = np.zeros((len(p.terms), len(here)), np.int64)
                values[term[a:b], np.searchsorted(here, doc[a:b])] = value[a:b]
                top.add(accumulated(p, values), ids[here])
        if top:
            ids = pa.array(top.id, mask=top.id == NO_ID)
            yield pa.RecordBatch.from_pydict({"place": pa.array(top.query.astype(np.int32)), "doc_id": ids, "score": pa.array(top.score)})

    return work


def _ranked(rows: DataFrame, by: str, best: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def shared_search(documents: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents (doc_id, text) of each item (item_id, text), by score.

    Only documents with a score above 0 are ranked; equal scores go by rising
    doc_id, null last. Null or empty texts have no terms: such an item finds
    nothing, such a document isn't found and doesn't count. Rows with the same
    id are documents, or items, of their own, each with its own result. Empty
    tables give no rows; other columns are left out. Whole texts are read; a
    task holds one text and its terms at least.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    index = materialise(term_counts(docs).filter("n > 0"), "search-index")
    named = term_counts(items.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text"))).filter("n > 0")
    named = materialise(named.withColumn("query", F.sha2(F.concat("terms", F.lit("|"), "counts"), 256)), "search-items")
    queries = named.groupBy("query").agg(F.any_value("terms").alias("terms"), F.any_value("counts").alias("counts"), F.any_value("n").alias("n"))
    n_blocks = -(-(queries.agg(F.sum("n")).first()[0] or 0) // block_terms)
    size = index.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    path, found = new_path(spark, "search-ranks"), spark.createDataFrame([], RANKED)
    if n_blocks and size.documents:
        plans = _in_blocks(queries, n_blocks).groupBy("block").applyInArrow(_planned(block_terms), PLAN_ROW)
        plans = materialise(plans, "search-plans")
        for row in plans.toLocalIterator():  # one bounded block after the other
            _write_block(index, row, size, best, path)
        found = spark.read.schema(RANKED).parquet(path)
    out = named.select(F.col("id").alias("item_id"), "query").join(found, "query")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


RANKED = "query string, doc_id long, score long, rank int"


def _write_block(index: DataFrame, row, size, best: int, path: str) -> None:
    """Add one block's ``RANKED`` rows to the files in ``path``."""
    context = index.sparkSession.sparkContext
    plan = context.broadcast(_plan(row))
    df = np.zeros(len(plan.value.terms), np.int64)
    counted = index.select("terms", "counts").mapInArrow(_frequencies(plan), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect():  # at most the block's terms
        df[r.term] = r.df
    weight = context.broadcast(weights(size.documents, df))
    scores = index.mapInArrow(_scored(plan, weight, size.documents, size.terms, best), "place int, doc_id long, score long")
    ranked = _ranked(scores, "place", best).withColumn("query", F.get(F.lit(row.queries), "place"))
    ranked.select("query", "doc_id", "score", "rank").write.mode("append").parquet(path)
    for sent in (plan, weight):
        sent.destroy()
