"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from specloom.session import materialise

# A key is hot if it holds more rows than a block takes, but at least a millionth
# of all rows. So there are at most a million hot keys per side, whatever the
# data: some tens of MB, safe to broadcast.
MAX_HOT_KEYS = 1_000_000


def _hot_counts(df: DataFrame, keys: list[str], target_rows: int, name: str) -> DataFrame:
    """(keys, count) of the keys with more than ``target_rows`` rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    total = counts.agg(F.sum(name)).scalar()
    limit = F.greatest(F.lit(target_rows).cast("bigint"), (total / MAX_HOT_KEYS).cast("bigint"))
    return counts.filter(F.col(name) > limit)


def _settled(hot: DataFrame) -> DataFrame | None:
    """None when no key is hot, as usual; else the hot keys, written once.

    Both sides of a join must see the very same parts, and the plan that
    follows is free of the counting.
    """
    return None if hot.isEmpty() else materialise(hot, "hot-keys")


def _parts(count: str, target_rows: int) -> Column:
    return F.ceil(F.coalesce(F.col(count), F.lit(1)) / target_rows).cast("int")


def _part_of(identity: list[str], parts: Column) -> Column:
    return F.pmod(F.xxhash64(*identity), parts).cast("int")


def _spread(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _renewed(df: DataFrame) -> list[Column]:
    """The columns under new identities, for joining two forms of one table."""
    return [F.col(c).alias(c) for c in df.columns]


def split_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: list[str],
    right_id: list[str],
    left_rows: int,
    right_rows: int,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut every hot key into a grid of bounded blocks.

    A hot key's left rows are dealt to ``_lp`` and its right rows to ``_rp`` by
    a hash of their ids; each row is repeated along the other side's parts, so
    every (left, right) pair of the key meets in exactly one block. Keys that
    are not hot stay whole and are not repeated. The keys of both sides are
    counted first, so hand in stored tables: counting reads the keys only.
    """
    hot_left = _hot_counts(left, keys, left_rows, "_nl")
    hot_right = _hot_counts(right, keys, right_rows, "_nr")
    hot = _settled(
        hot_left.join(hot_right, keys, "full").select(
            *keys, _parts("_nl", left_rows).alias("_lparts"), _parts("_nr", right_rows).alias("_rparts")
        )
    )
    if hot is None:
        whole = [F.lit(0).alias("_lp"), F.lit(0).alias("_rp")]
        return left.select("*", *whole), right.select(*_renewed(right), *whole), [*keys, "_lp", "_rp"]
    one = F.lit(1)
    lparts, rparts = F.coalesce("_lparts", one), F.coalesce("_rparts", one)

    def cut(df):
        return df.join(F.broadcast(hot), keys, "left")

    left = cut(left).select(
        *left.columns, _part_of(left_id, lparts).alias("_lp"), _spread(rparts).alias("_rp")
    )
    right = cut(right).select(
        *_renewed(right), _part_of(right_id, rparts).alias("_rp"), _spread(lparts).alias("_lp")
    )
    return left, right, [*keys, "_lp", "_rp"]


def triangle(rows: DataFrame, identity: list[str], block_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """``rows`` with themselves, in blocks of which each unordered pair is made once.

    The rows are counted and dealt to parts of about ``block_rows``; of two
    parts the one with the smaller number is the left side. A block with equal ``_lp`` and
    ``_rp`` holds a part with itself. Each row is sent to parts + 1 blocks, where a
    square grid would take two times the parts.
    """
    parts = max(-(-rows.count() // block_rows), 1)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*identity), F.lit(parts)).cast("int"))
    own = F.col("_part")
    left = dealt.select(*rows.columns, own.alias("_lp"), F.explode(F.sequence(own, F.lit(parts - 1))).alias("_rp"))
    right = dealt.select(*_renewed(rows), F.explode(F.sequence(F.lit(0), own)).alias("_lp"), own.alias("_rp"))
    return left, right, ["_lp", "_rp"]


def blocks_of(left: DataFrame, right: DataFrame, cells: list[str]):
    """Both sides grouped by ``cells``, for ``applyInArrow`` over a block's batches (``two_sides``).

    Other than a cogroup this can hand on a block's result piece by piece.
    """
    sides = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    return sides.groupby(*cells)


def two_sides(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table]:
    table = pa.Table.from_batches(batches)
    left = table.column("_left")
    return table.filter(left).combine_chunks(), table.filter(pc.invert(left)).combine_chunks()


def tiles(n_left: int, n_right: int, scores_at_once: int):
    """Slices of both sides, so that a tile holds about ``scores_at_once`` pairs; all tiles of a left slice in a row."""
    step = max(int(scores_at_once**0.5), 1)
    for at in range(0, n_left, step):
        for to in range(0, n_right, step):
            yield slice(at, min(at + step, n_left)), slice(to, min(to + step, n_right))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    row_id: list[str],
    how: str = "inner",
    target_rows: int = 1_000_000,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Join many rows to a table with few rows per key.

    A table counted to have at most ``broadcast_rows`` rows is broadcast: the
    rows stay where they are. Beyond that both sides are shuffled. Hot keys of ``rows`` are dealt to several salts, and the table's rows of
    those keys are repeated once per salt. For this the keys of ``rows`` are
    counted first, so hand in stored rows.
    """
    if broadcast_rows and table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table.select(*_renewed(table))), keys, how)
    hot = _settled(
        _hot_counts(rows, keys, target_rows, "_n").select(*keys, _parts("_n", target_rows).alias("_salts"))
    )
    if hot is None:
        return rows.join(table.select(*_renewed(table)), keys, how)
    salts = F.coalesce("_salts", F.lit(1))
    dealt = rows.join(F.broadcast(hot), keys, "left").select(
        *rows.columns, _part_of(row_id, salts).alias("_salt")
    )
    repeated = table.join(F.broadcast(hot), keys, "left").select(
        *_renewed(table), _spread(salts).alias("_salt")
    )
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
