"""Line dedup: winnowed line hashes find runs of lines that occurred earlier, and delete them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.llm import textkernel as K
from specloom.llm.anchors import rebuilt, removed_mask, repeated_spans, texts_and_rest

# The shortest run of lines that counts as a repeat.
LINES = 3


def _kept(batches):
    for part in K.text_slices(batches):
        texts, kept, counts, removed = part.column("text").to_pylist(), [], [], []
        for text, spans in zip(texts, part.column("spans").to_pylist()):
            lines = (text or "").split("\n")
            filled = [i for i, line in enumerate(lines) if line]
            mask = removed_mask(spans, len(filled))
            counts.append(len(filled))
            removed.append(0 if mask is None else int(mask.sum()))
            if mask is not None:
                gone = {i for i, out in zip(filled, mask.tolist()) if out}
                text = "\n".join(line for i, line in enumerate(lines) if i not in gone)
            kept.append(text)
        yield pa.RecordBatch.from_pydict(
            {
                "rest": part.column("rest"),
                "n_lines": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(kept, pa.string()),
            }
        )


def line_dedup(documents: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, n_lines, n_removed, text, and any other columns): each row of ``documents`` without later repeated runs of lines.

    Lines end at a line feed; empty ones aren't counted and stay. A line goes
    if it lies in ``lines`` consecutive lines that also start at a smaller
    (doc_id, line), in the same or another document; runs are judged on the
    input. So the first of several copies keeps its lines. A text all of whose
    lines go becomes empty; its row stays. Null text stays null; rows without a doc_id
    come after all others, as one document; repeated rows are treated alike.
    Other columns stay, but one named
    n_lines or n_removed.
    """
    docs = texts_and_rest(documents)
    found = repeated_spans(docs, K.line_spans, 1, lines, by_place=True)
    return rebuilt(documents, docs, found, _kept, "n_lines")


def line_digest(documents: DataFrame) -> DataFrame:
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return line_dedup(documents.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))
