"""Vectorised splitting and hashing of the texts of an Arrow batch (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
PIECE_BYTES = 200_000
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes half of the output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U64))
BASE = U64(0x9E3779B97F4A7C15)
# Words are runs of other bytes than these.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def powers(n: int) -> np.ndarray:
    """1, BASE, BASE**2, ... modulo 2**64."""
    out = np.full(max(n, 1), BASE, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text (or one long text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffer(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word."""
    return _spans(~IS_SPACE[data], offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every line that isn't empty."""
    return _spans(data != 10, offsets)


def _spans(inside: np.ndarray, offsets: np.ndarray):
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True  # texts lie side by side
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (none is empty)."""
    lengths = ends - starts
    total = np.cumsum(lengths)
    out = np.empty(len(starts), U64)
    weights = powers(int(lengths.max(initial=1)))
    at = 0
    while at < len(starts):  # a piece at a time: small arrays stay in the cache
        base = total[at] - lengths[at]
        to = max(int(np.searchsorted(total, base + PIECE_BYTES, "right")), at + 1)
        size = lengths[at:to]
        first = total[at:to] - size - base
        where = np.arange(int(total[to - 1] - base), dtype=np.int32)
        place = where - np.repeat(first, size).astype(np.int32)
        values = BYTE_CODES[data[where + np.repeat(starts[at:to] - first, size)]]
        values *= weights[place]
        out[at:to] = np.add.reduceat(values, first)
        at = to
    return mix(out + lengths.astype(U64))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive items; also across texts, see ``same_text``."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.zeros(count, U64)
    for k, weight in enumerate(mix(np.arange(7, 7 + n, dtype=U64))):
        total += hashes[k : k + count] * (weight | U64(1))
    return mix(total)


def same_text(doc: np.ndarray, n: int) -> np.ndarray:
    """Whether the n items from here on lie in one text."""
    count = len(doc) - n + 1
    return doc[:count] == doc[n - 1 :] if count > 0 else np.zeros(0, bool)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return first, np.diff(np.append(first, len(sorted_values)))


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs that Spark has."""
    return values.view(np.int64)
