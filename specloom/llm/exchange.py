"""Dealing many small values by key, packed: one row per task slice and bucket.

Billions of 64-bit hashes would be billions of rows. Here a mapper packs what
belongs to one bucket (a range of keys) into one row of byte strings, Spark
shuffles those rows, one bucket to each partition, and the reducer works on the bucket's arrays. A bucket is 1 /
``spark.sql.shuffle.partitions`` of the values, so the setting bounds a task's
memory at any size. Mappers send a key at most once per slice where they can.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

U64 = np.uint64


def bucket_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Equal ranges of the upper 32 bits of the key."""
    return (((keys >> U64(32)) * U64(n)) >> U64(32)).astype(np.int32)


def packed_schema(runs: dict[str, type], items: dict[str, type]) -> str:
    return ", ".join(["bucket int", "run_items binary", *(f"{n} binary" for n in [*runs, *items])])


def pack_through(values: dict[str, np.ndarray], by: np.ndarray, packed: pa.RecordBatch | None, schema: pa.Schema) -> pa.RecordBatch:
    """Deal arrays that the reducer gets as they are over the rows, by the hashes ``by``."""
    n = packed.num_rows if packed else 1
    out = {f.name: packed.column(f.name) if packed and f.name in packed.schema.names else pa.nulls(n, f.type) for f in schema}
    if not packed:
        out["bucket"] = pa.array([0], pa.int32())
    row = bucket_of(by, n)
    order = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[order], np.arange(n + 1))
    for k, v in values.items():
        v = v[order]
        out[k] = pa.array([v[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())
    return pa.RecordBatch.from_pydict(out, schema)


def pack(bucket: np.ndarray, run: np.ndarray, runs: dict[str, np.ndarray], items: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket. ``run`` gives each item's place in the arrays of ``runs`` (per document, ascending)."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 65536 else bucket, kind="stable")
    bucket, run = bucket[order], run[order]
    change = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (run[1:] != run[:-1])))
    run_first = np.flatnonzero(change)
    run_length = np.diff(np.append(run_first, len(run))).astype(np.uint32)
    run_bucket = bucket[run_first]
    first = np.flatnonzero(np.concatenate(([True], run_bucket[1:] != run_bucket[:-1])))
    run_cut = np.append(first, len(run_bucket))
    item_cut = np.append(run_first[first], len(bucket))
    which = run[run_first]

    def cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())

    columns = {"bucket": pa.array(run_bucket[first], pa.int32()), "run_items": cut(run_length, run_cut)}
    columns |= {n: cut(v[which], run_cut) for n, v in runs.items()}
    columns |= {n: cut(v[order], item_cut) for n, v in items.items()}
    return pa.RecordBatch.from_pydict(columns)


def joined(batches: list[pa.RecordBatch], name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for b in batches for x in b.column(name).to_pylist() if x)])


def exchanged(
    packed: DataFrame,
    runs: dict[str, type],
    items: dict[str, type],
    reduce: Callable[[dict], Iterator[pa.RecordBatch]],
    schema: str,
    repeat: bool = True,
    n_buckets: int | None = None,
) -> DataFrame:
    """Bring each bucket into one partition and apply ``reduce`` to its arrays.

    Values of ``runs`` are repeated for each of their items; else ``run_items``
    tells how many items each run has. ``n_buckets`` is given where the
    mappers dealt to another number of buckets than shuffle partitions.
    """
    n = n_buckets or bucket_count(packed)

    def work(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            length = joined(batches, "run_items", np.uint32)
            arrays = {k: joined(batches, k, t) for k, t in runs.items()}
            arrays = {k: np.repeat(v, length) for k, v in arrays.items()} if repeat else arrays | {"run_items": length}
            arrays |= {k: joined(batches, k, t) for k, t in items.items()}
            del batches
            yield from reduce(arrays)

    return packed.repartitionById(n, F.col("bucket")).mapInArrow(work, schema)
