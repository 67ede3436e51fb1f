"""Repeated windows of words or lines: winnowed anchors, joined and extended.

The hashes of k consecutive items are winnowed: of each ``w`` neighbours the
smallest (the last of equal ones) is an anchor. So any two equal stretches of
``k + w - 1`` items, the shortest that count, hold the same anchor at the same
place. Anchors meet in Spark by their hash; where several occurrences meet,
each is extended to both sides, by the window hashes that its anchor owns, and
those windows are marked that also start earlier. Overlapping and adjacent
marked windows make one span, so spans are maximal.

An occurrence is compared with all others of its anchor at once, by sorting,
never pair by pair. A window that occurs often in one slice of a task leaves
it only once: later ones are marked where they are. So a passage that a third
of all documents hold sends one value per slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64, bucket_count, bucket_of, exchanged, pack, pack_through, packed_schema
from specloom.llm.runtime import quoted

# Half of the anchor only chooses what is compared; all bits of the windows decide, as a common anchor has as many
# different windows as the corpus has surroundings of it. Equal windows have their anchor at the same place.
RUNS = {"doc": np.int64, "mark": np.uint32, "anchor": np.uint32, "at": np.uint32}
ITEMS = {"check": U64}
LOCAL = {"own_doc": np.int64, "own_mark": np.uint32, "own_at": np.uint32}
COLUMNS = ["run_items", *RUNS, *ITEMS, *LOCAL]
SCHEMA = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in COLUMNS)])
LAST_ID = np.iinfo(np.int64).max
SPANS = "doc long, mark long, spans binary"


def text_mark(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """32 bits of each text's hash: tells rows of one doc_id apart."""
    out = np.zeros(len(offsets) - 1, np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    out[some] = (K.span_hashes(data, offsets[:-1][some], offsets[1:][some]) >> U64(32)).astype(np.uint32)
    return out


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """For each w neighbours, the place of their smallest hash (0 to w - 1, the last of equal ones)."""
    count = max(len(hashes) - w + 1, 0)
    best, place = hashes[:count].copy(), np.zeros(count, np.uint8)
    for s in range(1, w):
        other = hashes[s : s + count]
        less = other <= best
        best[less] = other[less]
        place[less] = s
    return place


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def _later(order_key: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """Which items aren't the first of their group, by the keys (most important first); equal keys count alike."""
    order = np.lexsort((*reversed(order_key), group))
    sorted_group = group[order]
    first, length = K.runs(sorted_group)
    head = np.repeat(order[first], length)
    later = np.zeros(len(order), bool)
    for key in order_key:
        later[order] |= key[order] != key[head]
    return later


def _anchored(spans, k: int, w: int, by_place: bool, n_buckets: int):
    size = k + w - 1

    def work(batches):
        for part in K.text_slices(batches):
            data, offsets = K.text_buffer(part.column("text"))
            ids, marks = _ids(part.column("doc_id")), text_mark(data, offsets)
            starts, ends, doc = spans(data, offsets)
            hashes = K.span_hashes(data, starts, ends)
            window = K.ngram_hashes(hashes, size)
            if not len(window):
                continue
            grams = K.ngram_hashes(hashes, k)
            place = winnow(grams, w)
            at = np.flatnonzero(K.same_text(doc, size))
            window, place, row = window[at], place[at], doc[at]
            anchor_at = at + place
            within = (at - np.searchsorted(doc, row)).astype(np.uint32)
            later = _later([ids[row], within] if by_place else [ids[row]], window)
            own = {"own_doc": ids[row[later]], "own_mark": marks[row[later]], "own_at": within[later]}
            send = np.flatnonzero(~later)
            packed = None
            if len(send):
                owner, row_s = anchor_at[send], row[send]
                head = np.ones(len(send), bool)
                head[1:] = (owner[1:] != owner[:-1]) | (send[1:] != send[:-1] + 1)
                run = np.cumsum(head) - 1
                send_head = send[head]
                runs = {
                    "doc": ids[row_s[head]],
                    "mark": marks[row_s[head]],
                    "anchor": grams[owner[head]].astype(np.uint32),
                    "at": within[send_head],
                }
                items = {"check": window[send]}
                packed = pack(bucket_of(K.mix(grams[owner]), n_buckets), run, runs, items)
            yield pack_through(own, K.mix(own["own_doc"].view(U64)), packed, SCHEMA)

    return work


def _extended(size: int, by_place: bool, n_buckets: int):
    def reduce(a):
        marked = [(a["own_doc"], a["own_mark"], a["own_at"])]
        if len(a["anchor"]):
            # Seeds: anchors of several occurrences (of several documents, when places don't matter).
            order = np.argsort(a["anchor"], kind="stable")
            first, length = K.runs(a["anchor"][order])
            doc = a["doc"][order]
            several = length > 1
            if not by_place:
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            seed = np.zeros(len(order), bool)
            seed[order] = np.repeat(several, length)
            # Extension: the windows around each seed.
            counts = a["run_items"].astype(np.int64)
            begin = np.cumsum(counts) - counts
            counts = counts[seed]
            if counts.sum():
                step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                same = a["check"][np.repeat(begin[seed], counts) + step]
                doc, mark = np.repeat(a["doc"][seed], counts), np.repeat(a["mark"][seed], counts)
                at = np.repeat(a["at"][seed], counts) + step.astype(np.uint32)
                later = _later([doc, at] if by_place else [doc], same)
                marked.append((doc[later], mark[later], at[later]))
        doc, mark, at = (np.concatenate(x) for x in zip(*marked))
        if len(doc):
            doc, mark, start, end = _maximal(doc, mark, at.astype(np.int64), at.astype(np.int64) + size)
            first = _heads(doc, mark)
            run = np.cumsum(first) - 1
            where = bucket_of(K.mix(doc.view(U64)), n_buckets)
            spans = {"start": start.astype(np.uint32), "end": end.astype(np.uint32)}
            yield pack(where, run, {"doc": doc[first], "mark": mark[first]}, spans)

    return reduce


def _heads(doc: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where another text begins."""
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    return head


def _maximal(doc, mark, start, end):
    """Join spans of a text that overlap or touch; sorted by text and place."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order], end[order]
    text = np.cumsum(_heads(doc, mark))
    # The furthest end so far within the text: texts are set apart by a step longer than any end.
    step = np.int64(2**33)
    reach = np.maximum.accumulate(end + text * step) - text * step
    head = np.ones(len(doc), bool)
    head[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], mark[first], start[first], reach[last]


def _per_text(a):
    """(doc, mark, spans) of each text."""
    doc, mark, start, end = _maximal(a["doc"], a["mark"], a["start"].astype(np.int64), a["end"].astype(np.int64))
    first = np.flatnonzero(_heads(doc, mark))
    cut = np.append(first, len(doc))
    spans = np.stack([start, end], axis=1).astype(np.uint32)
    for i in range(0, len(first), 20_000):
        own = first[i : i + 20_000]
        yield pa.RecordBatch.from_pydict(
            {
                "doc": pa.array(doc[own]),
                "mark": pa.array(mark[own].astype(np.int64)),
                "spans": pa.array([spans[x:y].tobytes() for x, y in zip(own, cut[i + 1 : i + 20_001])], pa.binary()),
            }
        )


def repeated_spans(documents: DataFrame, spans, k: int, w: int, by_place: bool) -> DataFrame:
    """(doc, mark, spans): each text's maximal spans of repeated items, as pairs of 32-bit places.

    Items are what ``spans`` finds. A window of k + w - 1 items is repeated if
    its items also start in a document with a smaller id or, ``by_place``, at
    a smaller (id, place). Rows without an id come after all others.
    """
    n_buckets = bucket_count(documents)
    mapped = documents.select("doc_id", "text").filter("text is not null").mapInArrow(
        _anchored(spans, k, w, by_place, n_buckets), "bucket int, " + ", ".join(f"{c} binary" for c in COLUMNS)
    )
    runs, spans_of = {"doc": np.int64, "mark": np.uint32}, {"start": np.uint32, "end": np.uint32}
    reduce = _extended(k + w - 1, by_place, n_buckets)
    found = exchanged(mapped, RUNS, ITEMS | LOCAL, reduce, packed_schema(runs, spans_of), repeat=False)
    return exchanged(found, runs, spans_of, _per_text, SPANS)


def with_spans(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text, rest) with their spans."""
    docs = documents.withColumn("_doc", F.coalesce("doc_id", F.lit(int(LAST_ID))))
    schema = StructType([*(docs.schema[c] for c in ("rest", "text", "_doc")), StructField("_mark", LongType())])
    docs = docs.select("rest", "text", "_doc").mapInArrow(_marked, schema)
    on = (docs["_doc"] == found["doc"]) & (docs["_mark"] == found["mark"])
    return docs.join(found, on, "left").select("rest", "text", "spans")


def _marked(batches):
    for part in K.text_slices(batches):
        data, offsets = K.text_buffer(part.column("text"))
        marks = pa.array(text_mark(data, offsets).astype(np.int64))
        columns = [part.column(c) for c in ("rest", "text", "_doc")]
        yield pa.RecordBatch.from_arrays([*columns, marks], ["rest", "text", "_doc", "_mark"])


def texts_and_rest(documents: DataFrame) -> DataFrame:
    """(doc_id, text, rest): ``rest`` holds all columns but the text."""
    rest = F.struct(*[quoted(c) for c in documents.columns if c != "text"])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))


def rebuilt(documents: DataFrame, docs: DataFrame, found: DataFrame, work, counted: str) -> DataFrame:
    """The columns of ``documents`` with the new text, and (counted, n_removed) before it; ``work`` makes them."""
    schema = StructType(
        [
            docs.schema["rest"],
            StructField(counted, LongType()),
            StructField("n_removed", LongType()),
            StructField("text", StringType()),
        ]
    )
    new = with_spans(docs, found).mapInArrow(work, schema)
    rest = [F.col("rest").getField(c).alias(c) for c in documents.columns if c not in ("text", counted, "n_removed")]
    return new.select(*rest, counted, "n_removed", "text")


def removed_mask(spans: bytes | None, n: int) -> np.ndarray | None:
    """Which of n items lie in a span."""
    if not spans or not n:
        return None
    spans = np.frombuffer(spans, np.uint32).reshape(-1, 2).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(spans[:, 0], n), 1)
    np.add.at(edge, np.minimum(spans[:, 1], n), -1)
    return np.cumsum(edge[:-1]) > 0
