"""Positions, chunks and id sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from specloom.operators.greedy_chunks import greedy_chunks
from specloom.session import materialise

# Fixed value: bytes after which a chunk is closed.
DEFAULT_CHUNK_BYTES = 100_000_000

# Bytes a record takes besides its peaks.
RECORD_OVERHEAD = 1_184


def _range_sorted(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Rows in global order, with ``_part`` and ``_line`` inside the part.

    Range boundaries are sampled, so the sorted rows are written once: a second
    evaluation, or a lost executor, cannot see other boundaries. A hash of the
    row is the last sort key and splits long runs of equal ids.
    """
    keys = [*order_by, F.xxhash64(*df.columns)]
    line = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*",
        F.shiftright(line, 33).cast("int").alias("_part"),
        line.bitwiseAND(F.lit((1 << 33) - 1)).alias("_line"),
    )
    return materialise(placed, "positions")


def _with_offsets(placed: DataFrame, measure, name: str) -> DataFrame:
    """Add the sum of ``measure`` over all parts before the row's own.

    One row per partition: a table bounded by the number of partitions.
    """
    totals = placed.groupBy("_part").agg(measure.alias("_total"))
    before = F.sum("_total").over(Window.orderBy("_part")) - F.col("_total")
    return placed.join(F.broadcast(totals.select("_part", before.alias(name))), "_part")


def with_position(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Add ``position``, 0 to n - 1 in global order, without a global window."""
    placed = _with_offsets(_range_sorted(df, order_by), F.count("*"), "_offset")
    return placed.withColumn("position", F.col("_offset") + F.col("_line")).drop(
        "_part", "_line", "_offset"
    )


def chunk_ids(ids: DataFrame, chunk_size: int, order_by: list[str] | None = None) -> DataFrame:
    """Number lists of ``chunk_size`` ids; the last one may be shorter."""
    ordered = with_position(ids, order_by or ids.columns)
    return ordered.withColumn("chunk", F.floor(F.col("position") / chunk_size)).drop("position")


def chunk_by_bytes(
    raw: DataFrame, chunk_size: int = DEFAULT_CHUNK_BYTES, order_by: str = "spectrum_id", rule: str = "greedy"
) -> DataFrame:
    """(order_by, n_bytes, chunk): records cut into chunks of about ``chunk_size`` bytes.

    Every record has one chunk, and the order is kept. ``rule="greedy"``: a chunk
    is closed by the record with which it has ``chunk_size`` bytes or more, and
    the next one begins. ``rule="offset"``: a record belongs to the chunk in
    which its first byte falls, counted over the whole library, so a chunk's
    overshoot shortens the next one; this takes one pass less.
    """
    if rule not in ("greedy", "offset"):
        raise ValueError('rule must be "greedy" or "offset"')
    sized = raw.select(
        order_by, (F.octet_length("peaks_json") + RECORD_OVERHEAD).cast("bigint").alias("n_bytes")
    )
    ranges = _range_sorted(sized, [order_by])
    if rule == "greedy":
        return greedy_chunks(ranges, chunk_size, order_by)
    placed = _with_offsets(ranges, F.sum("n_bytes"), "_offset")
    running = F.sum("n_bytes").over(
        Window.partitionBy("_part").orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("_offset") + running - F.col("n_bytes")
    return placed.select(order_by, "n_bytes", F.floor(start / chunk_size).alias("chunk"))


def flatten_batches(batches: list[DataFrame]) -> DataFrame:
    """Chunked results as one set."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def id_difference(new: DataFrame, existing: DataFrame) -> DataFrame:
    return new.subtract(existing)


def id_union(sets: list[DataFrame]) -> DataFrame:
    return flatten_batches(sets).distinct()


def id_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)
