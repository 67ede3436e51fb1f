"""Closing one chunk after another, in parallel.

A chunk is closed by the record that fills it, so where chunks begin depends on
all records before. Of these a range of records only needs to know how many
bytes are open when it begins. So each range is a map from open bytes to
open bytes and chunks closed; it is a step function, with a step for each record that may close
the first chunk. Maps of neighbouring ranges are composed, ``FAN`` at a time, to one; then
the first state is handed down the same way, and every range numbers its own records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.session import materialise

# Maps that are composed in one task; a map has a step for each record in the first chunk's bytes.
FAN = 16
MAP = "node int, low long, exit long, closed long, moves boolean"
STATE = "node int, open long, chunk long"


class StepMap:
    """From ``low[i]`` on, open bytes o become ``exit[i]``, and o more if ``moves[i]``; ``closed[i]`` chunks are closed."""

    def __init__(self, low, exit_, closed, moves):
        self.low, self.exit, self.closed, self.moves = low, exit_, closed, moves

    def __call__(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i = np.searchsorted(self.low, at, "right") - 1
        return self.exit[i] + np.where(self.moves[i], at, 0), self.closed[i], self.moves[i]

    def then(self, other: StepMap) -> StepMap:
        """This map, and the other one behind it."""
        end, closed, _ = other(self.exit)
        low, exit_, closed, moves = self.low, end, self.closed + closed, np.zeros(len(end), bool)
        if len(self.moves) and self.moves[0]:
            # Nothing is closed in here, so the bytes of this range come on top, and the other map's steps count from there.
            stop = self.low[1] if len(self.low) > 1 else np.iinfo(np.int64).max
            begin = np.maximum(other.low - self.exit[0], 0)
            keep = (begin < stop) & (np.append(begin[1:], np.iinfo(np.int64).max) > begin)
            shifted = other.exit + np.where(other.moves, self.exit[0], 0)
            low = np.concatenate((begin[keep], low[1:]))
            exit_ = np.concatenate((shifted[keep], exit_[1:]))
            closed = np.concatenate((other.closed[keep], closed[1:]))
            moves = np.concatenate((other.moves[keep], moves[1:]))
        return StepMap(low, exit_, closed, moves)


def range_map(sizes: np.ndarray, limit: int) -> StepMap:
    """The map of records of these sizes, when a chunk closes as soon as it has ``limit`` bytes."""
    upto = np.cumsum(sizes)
    n, total = len(sizes), int(upto[-1])
    # What a chunk that begins with record i leaves open at the end, and how many it and later ones close.
    ends = np.searchsorted(upto, upto - sizes + limit).tolist()
    before = (upto - sizes).tolist()
    left, closed = [0] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        if ends[i] == n:
            left[i] = total - before[i]
        else:
            left[i], closed[i] = left[ends[i] + 1], closed[ends[i] + 1] + 1
    first, last = int(np.searchsorted(upto, 1)), min(int(np.searchsorted(upto, limit)), n - 1)
    by = np.arange(last, first - 1, -1)  # the record that closes the open chunk: the more is open, the earlier
    low = np.maximum(limit - upto[by], 0)
    some = low < limit - np.where(by > 0, upto[by - 1], 0)
    by, low = by[some], low[some]
    exits, counts = np.array(left, np.int64)[by + 1], np.array(closed, np.int64)[by + 1] + 1
    moves = np.zeros(len(by), bool)
    if total < limit:
        low, exits, counts, moves = np.append(0, low), np.append(total, exits), np.append(0, counts), np.append(True, moves)
    return StepMap(low, exits, counts, moves)


def _table(node: int, m: StepMap) -> pa.Table:
    return pa.table(
        {"node": pa.array(np.full(len(m.low), node), pa.int32()), "low": pa.array(m.low, pa.int64()), "exit": pa.array(m.exit, pa.int64()), "closed": pa.array(m.closed, pa.int64()), "moves": pa.array(m.moves, pa.bool_())}
    )


def _maps(table: pa.Table) -> list[tuple[int, StepMap]]:
    """The maps in a table, by rising node."""
    table = table.sort_by([("node", "ascending"), ("low", "ascending")])
    node = table.column("node").to_numpy()
    columns = [table.column(c).to_numpy(zero_copy_only=False) for c in ("low", "exit", "closed", "moves")]
    cuts = np.flatnonzero(np.diff(node)) + 1
    parts = zip(np.split(node, cuts), *(np.split(c, cuts) for c in columns))
    return [(int(own[0]), StepMap(*rest)) for own, *rest in parts if len(own)]


def _leaf(limit: int):
    def work(name, rows):
        rows = rows.sort_by("_line")
        return _table(name[0].as_py(), range_map(rows.column("n_bytes").to_numpy(), limit))

    return work


def _composed(name, table):
    maps = [m for _, m in _maps(table)]
    whole = maps[0]
    for m in maps[1:]:
        whole = whole.then(m)
    return _table(name[0].as_py(), whole)


def _handed_down(name, states, table):
    """The first state of each node of a group, from that of the group."""
    out = []
    if states.num_rows:
        open_, chunk = states.column("open")[0].as_py(), states.column("chunk")[0].as_py()
        for node, m in _maps(table):
            out.append((node, open_, chunk))
            end, closed, _ = m(np.array([open_]))
            open_, chunk = int(end[0]), chunk + int(closed[0])
    return pa.table({c: pa.array([r[k] for r in out], kind) for k, (c, kind) in enumerate((("node", pa.int32()), ("open", pa.int64()), ("chunk", pa.int64())))})


def _numbered(limit: int, order_by: str):
    def work(name, states, rows):
        rows = rows.sort_by("_line")
        upto = np.cumsum(rows.column("n_bytes").to_numpy())
        chunk = np.empty(len(upto), np.int64)
        at, open_, number = 0, states.column("open")[0].as_py(), states.column("chunk")[0].as_py()
        while at < len(upto):
            before = upto[at - 1] if at else 0
            end = min(int(np.searchsorted(upto, before + limit - open_)) + 1, len(upto))
            chunk[at:end] = number
            at, open_, number = end, 0, number + 1
        return pa.table({order_by: rows.column(order_by), "n_bytes": rows.column("n_bytes"), "chunk": pa.array(chunk)})

    return work


def greedy_chunks(placed: DataFrame, limit: int, order_by: str, fan: int = FAN) -> DataFrame:
    """(order_by, n_bytes, chunk) of records (order_by, n_bytes, _part, _line) in ranges ``_part``, numbered by ``_line`` in each.

    A chunk is closed by the first record with which it has ``limit`` bytes or more.
    """
    level = materialise(placed.select("_part", "_line", "n_bytes").groupBy("_part").applyInArrow(_leaf(limit), MAP), "chunk-maps")
    levels = [level]
    while levels[-1].agg(F.max("node")).first()[0]:
        group = levels[-1].withColumn("group", (F.col("node") / fan).cast("int")).groupBy("group")
        levels.append(materialise(group.applyInArrow(_composed, MAP), "chunk-maps"))
    spark = placed.sparkSession
    states = spark.range(1).select(F.lit(0).alias("node"), F.lit(0).cast("long").alias("open"), F.lit(0).cast("long").alias("chunk"))
    for level in levels[-2::-1]:
        given = states.withColumnRenamed("node", "group")
        below = level.withColumn("group", (F.col("node") / fan).cast("int"))
        states = materialise(given.groupBy("group").cogroup(below.groupBy("group")).applyInArrow(_handed_down, STATE), "chunk-states")
    given = states.withColumnRenamed("node", "_part")
    kind = placed.schema[order_by].dataType.simpleString()
    return given.groupBy("_part").cogroup(placed.groupBy("_part")).applyInArrow(_numbered(limit, order_by), f"`{order_by}` {kind}, n_bytes long, chunk long")
