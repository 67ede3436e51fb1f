"""JSON records in any layout, read in byte ranges: arrays over many lines, several arrays in a row, or lines.

Spark's text source cuts a file into ranges at any one-byte separator. With
``}`` as the separator every record ends where a row ends, in any layout. What a
row is part of depends on all the text before it, but only on two things: whether
a string is open, and how many braces are. A row maps this state to the next
one, and so does a range: its map is three numbers. So

1. each range is summed up, and running sums give every range's first state;
2. the pieces of records that ranges cut through are put together;
3. the ranges are read once more, each from its first state, and give whole records.

Only the three numbers of each range reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from specloom.session import materialise

QUOTE, BACKSLASH, OPEN = b'"'[0], b"\\"[0], b"{"[0]
# What may stand between records, and after the last one.
BETWEEN = b" \t\r\n,[]\xef\xbb\xbf"
# Ranges whose states one broadcast holds, at some hundred bytes each; more files than that are read in groups.
MAX_RANGES = 500_000
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")

ROWS = ["file", "start", "value"]


@dataclass
class _Run:
    """Rows of one range that lie together in a batch."""

    key: tuple[str, int]
    values: pa.LargeBinaryArray
    odd: np.ndarray  # whether a row has an odd number of quotes
    opened: np.ndarray  # (rows, 2): braces opened outside strings, if the row begins outside or inside one

    def states(self, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a string is open, and how many braces are, after each row and the brace that ends it."""
        after = (inside + np.cumsum(self.odd)) % 2
        before = np.concatenate(([inside], after[:-1]))
        change = self.opened[np.arange(len(before)), before] - (after == 0)
        return after, depth + np.cumsum(change)


def _runs(batches) -> Iterator[_Run]:
    for batch in batches:
        if batch.num_rows:
            values = batch.column("value").cast(pa.large_binary())
            odd, opened = _scanned(values)
            files, starts = batch.column("file"), batch.column("start").to_numpy()
            other = pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
            new = [0, *(np.flatnonzero(other | (starts[1:] != starts[:-1])) + 1).tolist(), len(files)]
            for a, b in zip(new[:-1], new[1:]):
                yield _Run((files[a].as_py(), int(starts[a])), values.slice(a, b - a), odd[a:b], opened[a:b])


def _scanned(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``odd`` and ``opened`` of each row. No escape reaches beyond a row: an escaped brace is no JSON."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    quotes = np.flatnonzero(data == QUOTE)
    # A quote counts unless an odd run of backslashes stands before it, in its row.
    behind = np.flatnonzero((data[np.maximum(quotes - 1, 0)] == BACKSLASH) & (quotes > 0)) if len(quotes) else quotes
    if len(behind):
        escaped = np.zeros(len(quotes), bool)
        row_start = offsets[np.searchsorted(offsets, quotes[behind], "right") - 1]
        place = quotes[behind] - 1
        while len(behind):
            more = (place >= row_start) & (data[np.maximum(place, 0)] == BACKSLASH)
            behind, row_start, place = behind[more], row_start[more], place[more] - 1
            escaped[behind] ^= True
        quotes = quotes[~escaped]
    braces = np.flatnonzero(data == OPEN)
    n = len(offsets) - 1
    row = lambda places: np.searchsorted(offsets, places, "right") - 1
    before = np.searchsorted(quotes, offsets)  # quotes before each row
    odd = np.diff(before) % 2
    of = row(braces)
    in_string = (np.searchsorted(quotes, braces) - before[of]) % 2
    opened = np.stack([np.bincount(of, in_string == k, n) for k in (0, 1)], axis=1).astype(np.int64)
    return odd, opened


def _only_between(value: bytes) -> bool:
    return not value.strip(BETWEEN)


SUMMARY = "file string, start long, odd int, change0 long, change1 long, n_bytes long, last_between boolean"


def _summed(batches):
    """One row per range: how it changes the state, its bytes, and whether its last row has nothing of a record."""

    def row(key, total):
        return pa.RecordBatch.from_pylist(
            [dict(zip(("file", "start", "odd", "change0", "change1", "n_bytes", "last_between"), (*key, *total)))],
            pa.schema([("file", pa.string()), ("start", pa.int64()), ("odd", pa.int32()), ("change0", pa.int64()), ("change1", pa.int64()), ("n_bytes", pa.int64()), ("last_between", pa.bool_())]),
        )

    key, total = None, None
    for run in _runs(batches):
        if run.key != key:
            if key:
                yield row(key, total)
            key, total = run.key, (0, 0, 0, 0, False)
        odd, *changes, n_bytes, _ = total
        # Begun inside or outside a string, a range so far has left the state ``odd`` further.
        ends = [run.states(first ^ odd, 0) for first in (0, 1)]
        changes = [int(changes[first] + ends[first][1][-1]) for first in (0, 1)]
        size = pc.sum(pc.binary_length(run.values)).as_py() + len(run.values)
        total = (int(ends[0][0][-1]), *changes, n_bytes + size, _only_between(run.values[-1].as_py()))
    if key:
        yield row(key, total)


@dataclass(frozen=True)
class _First:
    """The state in which a range begins."""

    inside: int
    depth: int
    last: bool  # its last row is the end of the file, behind the last brace


def _cut(states, fragments: bool):
    """Whole records of each range, or the pieces of those that it shares with others."""

    def out(rows):
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("tail", pa.bool_()), ("text", pa.string())])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def closed(key, first, runs):
        """The range's records (True) and pieces, as (whole, tail, text)."""
        inside, depth, pending, whole = first.inside, first.depth, [], not (first.inside or first.depth)
        for run, is_last in runs:
            values, (after, depths) = run.values.to_pylist(), run.states(inside, depth)
            if is_last and first.last:
                values, after, depths = values[:-1], after[:-1], depths[:-1]
            if len(values):
                inside, depth = int(after[-1]), int(depths[-1])
            at = 0
            for end in np.flatnonzero((after == 0) & (depths == 0)).tolist():
                text = b"}".join([*pending, *values[at : end + 1], b""])
                yield whole, False, text
                pending, at, whole = [], end + 1, True
            pending += values[at:]
        if pending:
            yield False, whole, b"}".join([*pending, b""])

    def work(batches):
        rows = []
        for key, runs in _by_range(_runs(batches)):
            first = states.value.get(key)
            if first is None:
                raise RuntimeError(f"the byte ranges of {key[0]} have changed since they were summed up; leave spark.sql.files settings as they were")
            for whole, tail, text in closed(key, first, runs):
                if whole != fragments:
                    rows.append((*key, tail, text.decode()) if fragments else (None, None, None, text.decode()))
                    if len(rows) == 1000:
                        yield out(rows)
                        rows = []
        if rows:
            yield out(rows)

    return work


def _by_range(runs: Iterator[_Run]):
    """(key, [(run, whether it's the range's last)]) of consecutive runs; nothing is read ahead but one run."""
    ahead = next(runs, None)
    while ahead:
        key = ahead.key

        def own():
            nonlocal ahead
            while True:
                run, ahead = ahead, next(runs, None)
                last = ahead is None or ahead.key != key
                yield run, last
                if last:
                    return

        yield key, own()


def _states(summaries: list, sizes: dict[str, int]) -> dict[tuple[str, int], _First]:
    """The first state of each range of one file, in order; refuses a file that ends within a record."""
    states, inside, depth, n_bytes = {}, 0, 0, 0
    for k, s in enumerate(summaries):
        first = inside, depth
        depth += s.change1 if inside else s.change0
        inside ^= s.odd
        n_bytes += s.n_bytes
        # What follows the last brace is no row that a brace ends; the one counted for it is too many.
        last = k == len(summaries) - 1 and s.last_between and depth == -1
        states[s.file, s.start] = _First(*first, last)
    end = summaries[-1]
    if inside or depth + last != 0:
        raise ValueError(f"{end.file} ends within a record or has a brace too many")
    # A file that lacks its very last brace looks alike, but for its size. A byte order mark is no part of the text.
    size = sizes[end.file] + last
    if not end.file.endswith(COMPRESSED) and n_bytes not in (size, size - 3):
        raise ValueError(f"{end.file} ends within a record or has a brace too many")
    return states


def record_texts(spark: SparkSession, paths) -> DataFrame:
    """(text): the text of every top-level object in the files, each an element of an array or standing alone.

    Layout doesn't matter: arrays of any length over any lines, several in a
    file, or a record per line. Uncompressed files are read in ranges, by any
    number of tasks. Objects within objects belong to these. Blank files have no
    records. What isn't an object is refused, and so is a file that ends too early.
    """
    lines = spark.read.option("lineSep", "}").text(paths)
    found = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    summaries = materialise(found.mapInArrow(_summed, SUMMARY).join(_sizes(spark, paths), "file"), "json-ranges")
    parts = []
    for group in _groups(summaries):
        states, several = {}, False
        for file in group:
            states |= _states(file, {s.file: s.size for s in file})
            several |= len(file) > 1
        sent = spark.sparkContext.broadcast(states)
        own = found
        if len(parts) or group.more:
            own = found.join(F.broadcast(spark.createDataFrame([(f[0].file,) for f in group], "file string")), "file", "left_semi")
        schema = "file string, start long, tail boolean, text string"
        parts.append(own.mapInArrow(_cut(sent, fragments=False), schema).select("text"))
        if several:
            parts.append(materialise(_joined(own.mapInArrow(_cut(sent, fragments=True), schema)), "json-pieces"))
    texts = parts[0] if parts else spark.createDataFrame([], "text string")
    for more in parts[1:]:
        texts = texts.unionByName(more)
    begin = F.instr("text", "{")
    before = F.substring("text", F.lit(1), begin - 1)
    refused = F.raise_error(F.concat(F.lit("not a record: "), F.substring("text", 1, 80)))
    between = before.rlike(r"^[ \t\r\n,\[\]\x{FEFF}]*$")
    return texts.select(F.when((begin > 0) & between, F.substring("text", begin, F.length("text"))).otherwise(refused).alias("text"))


def _sizes(spark: SparkSession, paths) -> DataFrame:
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))


class _Group(list):
    """The summaries of some files; ``more``: there are other groups."""

    more = False


def _groups(summaries: DataFrame) -> Iterator[_Group]:
    """Files with up to ``MAX_RANGES`` ranges together, each as the list of its ranges in order."""
    group, n = _Group(), 0
    for s in summaries.orderBy("file", "start").toLocalIterator():
        if not group or group[-1][0].file != s.file:
            if n >= MAX_RANGES:
                group.more = True
                yield group
                group, n = _Group(), 0
            group.append([])
        group[-1].append(s)
        n += 1
    if group:
        yield group


def _joined(pieces: DataFrame) -> DataFrame:
    """(text): pieces put together from the range in which a record begins to that in which it ends."""
    order = Window.partitionBy("file").orderBy("start", "tail")
    begun = F.last(F.when(F.col("tail"), F.col("start")), ignorenulls=True).over(order)
    together = pieces.withColumn("begun", begun).groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("start", "tail", "text"))).alias("p"))
    return together.select(F.array_join(F.col("p.text"), "").alias("text"))
