"""Substring dedup by seed and extend: maximal repeated stretches of words go, wherever a smaller doc_id has them."""

from __future__ import annotations

from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.llm import textkernel as K
from specloom.llm.anchors import rebuilt, removed_mask, repeated_spans, texts_and_rest

WORDS = 13
ANCHOR_WORDS = 5


def _kept(batches):
    for part in K.text_slices(batches):
        texts, kept, counts, removed = part.column("text").cast(pa.binary()).to_pylist(), [], [], []
        for text, spans in zip(texts, part.column("spans").to_pylist()):
            words = (text or b"").split()
            mask = removed_mask(spans, len(words))
            counts.append(len(words))
            removed.append(0 if mask is None else int(mask.sum()))
            kept.append(None if text is None else b" ".join(words if mask is None else compress(words, ~mask)))
        yield pa.RecordBatch.from_pydict(
            {
                "rest": part.column("rest"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )


def substring_dedup(documents: DataFrame, words: int = WORDS, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, text, and any other columns): each row of ``documents`` with its repeated stretches removed.

    A word goes if it lies in a window of ``words`` words that also starts in
    a document with a smaller doc_id; windows are judged on the input. ``text``
    has the kept words joined by one space. Null text stays null (no words);
    rows without a doc_id come after all others and not before each other;
    rows of one doc_id don't count against each other; repeated rows are
    treated alike. Other columns stay, but one named
    n_words or n_removed.
    """
    docs = texts_and_rest(documents)
    found = repeated_spans(docs, K.word_spans, anchor_words, words - anchor_words + 1, by_place=False)
    return rebuilt(documents, docs, found, _kept, "n_words")


def substring_digest(documents: DataFrame) -> DataFrame:
    """The digest of ``substring_dedup``: null text counts as empty."""
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return substring_dedup(documents.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))
