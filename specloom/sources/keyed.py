"""A keyed table in buckets: batches are added beside it, readers merge, buckets are compacted.

Rows lie in buckets by a hash of their id, under the partition columns. A batch
is written as a delta of the buckets it touches and nothing else is read or
written. Every change ends with a manifest: a numbered file that lists, for each
bucket, its base and the deltas on top. Readers resolve the last manifest, so a
job that dies before it has written one changes nothing, and a reader that
began earlier keeps its files. With each base and delta goes a Bloom filter of its ids.

One writer at a time is meant; of two that commit the same number, the later one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType

from specloom.session import materialise

BUCKET, VERSION, DELETED = "_bucket", "_version", "_deleted"
# Part of a bucket that one task writes; not stored.
SLICE = "_slice"
# Bits of a Bloom filter for each id, and how many of them an id sets.
ID_BITS, ID_HASHES = 12, 6
# Ids hashed at a time.
_IDS_AT_ONCE = 65_536


@dataclass
class _Manifest:
    """What is there: the schema, and of each bucket the folder of its base and those of its deltas in order."""

    number: int
    schema: str
    partition_by: list[str]
    n_buckets: int
    # {bucket folder: [[version, folder], ...]}; the first one is the base.
    parts: dict[str, list[list]] = field(default_factory=dict)
    filters: bool = True

    def next(self, parts: dict[str, list[list]]) -> _Manifest:
        return replace(self, number=self.number + 1, parts=parts)


class KeyedTable:
    """A table with one current row per (partition columns, key)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "spectrum_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    # Files and manifests

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath, jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        jpath, fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []

    def versions(self) -> list[int]:
        """The numbers of all committed versions, rising."""
        return sorted(int(n[1:-5]) for n in self._names(f"{self.path}/manifests") if n.startswith("m") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> _Manifest:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no table in {self.path}")
        number = versions[-1] if version is None else version
        jpath, fs = self._fs(f"{self.path}/manifests/m{number:010d}.json")
        stream = fs.open(jpath)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return _Manifest(**json.loads(text))

    def _commit(self, new: _Manifest) -> int:
        """Write the manifest under a name of its own, then give it its number: all at once or not at all."""
        name = f"{self.path}/manifests/m{new.number:010d}.json"
        made, fs = self._fs(f"{self.path}/manifests/.new-{uuid.uuid4().hex}")
        stream = fs.create(made, False)
        try:
            stream.write(bytearray(json.dumps(new.__dict__), "utf-8"))
        finally:
            stream.close()
        target, _ = self._fs(name)
        if fs.exists(target) or not fs.rename(made, target):
            fs.delete(made, False)
            raise RuntimeError(f"version {new.number} of {self.path} was committed by another writer")
        return new.number

    # Writing

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: StructType,
        partition_by: tuple[str, ...] = (),
        n_buckets: int = 64,
        key: str = "spectrum_id",
        filters: bool = True,
    ) -> KeyedTable:
        """An empty table; without ``filters`` of ids, ``only_new`` looks every id up. A bucket should hold some hundred MB: their number bounds what a batch of few ids touches."""
        table = cls(spark, path, key)
        _, fs = table._fs(path)
        fs.mkdirs(table._fs(f"{table.path}/manifests")[0])
        table._commit(_Manifest(0, schema.json(), list(partition_by), n_buckets, filters=filters))
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: StructType, partition_by: tuple[str, ...] = (), n_buckets: int = 64, key: str = "spectrum_id", filters: bool = True) -> KeyedTable:
        """The table in ``path``, created if there is none."""
        table = cls(spark, path, key)
        return table if table.versions() else cls.create(spark, path, schema, partition_by, n_buckets, key, filters)

    def _bucketed(self, df: DataFrame, n_buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(n_buckets)).cast("int"))

    def _dealt(self, df: DataFrame, manifest: _Manifest) -> DataFrame:
        """The rows by bucket, and each bucket in slices by another hash of the id.

        A task then sorts a slice and not a whole bucket, and few buckets do not mean few tasks.
        There are some slices for each shuffle partition, so that these get about the
        same; adaptive execution joins small ones.
        """
        slices = -(-4 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // manifest.n_buckets)
        cut = self._bucketed(df, manifest.n_buckets).withColumn(SLICE, F.pmod(F.hash(self.key), F.lit(slices)))
        return cut.repartition(*manifest.partition_by, BUCKET, SLICE)

    def _write(self, rows: DataFrame, old: _Manifest) -> dict[str, str]:
        """{bucket folder: data folder} of ``rows`` (dealt by bucket), written with a filter of each bucket's ids beside them."""
        name, by = f"c{uuid.uuid4().hex}", [*old.partition_by, BUCKET]
        rows.write.partitionBy(*by).parquet(f"{self.path}/data/{name}")
        folders = self._bucket_folders(f"{self.path}/data/{name}", len(by))
        if folders and old.filters:
            written = self._files(old, [f"{name}/{f}" for f in folders]).filter(~F.col(DELETED))
            # The path is that of a URI: what folder names escape is escaped once more.
            uri = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
            ids = written.select(self.key, F.regexp_extract(uri, f"/{name}/(.*)/[^/]*$", 1).alias("folder"))
            filters = ids.groupBy("folder").applyInArrow(_filter_of(self.key), "folder string, bits binary")
            filters.coalesce(1).write.parquet(f"{self.path}/filters/{name}")
        return dict.fromkeys(folders, name)

    def _bucket_folders(self, path: str, depth: int) -> list[str]:
        """The folders ``depth`` levels below ``path``; a commit has one for each bucket that it touches."""
        if not depth:
            return [""]
        below = [n for n in self._names(path) if "=" in n]
        return [f"{n}/{rest}".rstrip("/") for n in below for rest in self._bucket_folders(f"{path}/{n}", depth - 1)]

    def upsert(self, batch: DataFrame, order_by: list[str | Column]) -> int:
        """Insert or replace; the last write of an id, by ``order_by``, wins. Touches the batch's buckets only."""
        old = self.manifest()
        schema = self._schema(old)
        by = [*old.partition_by, self.key]
        last = F.max_by(F.struct(*[c for c in schema.fieldNames() if c not in by]), F.struct(*order_by))
        # Dealt by bucket first: then repeats lie together, and one shuffle does.
        rows = self._dealt(batch, old).groupBy(*by, BUCKET, SLICE).agg(last.alias("_row"))
        return self._add_dealt(rows.select(*by, BUCKET, "_row.*").select(*schema.fieldNames(), BUCKET), old, deleted=False)

    def append_new(self, batch: DataFrame, order_by: list[str | Column]) -> int:
        """Insert the ids that aren't stored; stored rows stay as they are."""
        return self.upsert(self.only_new(batch), order_by)

    def delete(self, ids: DataFrame) -> int:
        """Remove ids (a column of the key, and of the partition columns): a delta of marks."""
        old = self.manifest()
        names = self._schema(old).fieldNames()
        given = ids.select(*old.partition_by, self.key).distinct()
        rows = given.select(*[F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self._schema(old)])
        return self._add(rows.select(*names), old, deleted=True)

    def _add(self, rows: DataFrame, old: _Manifest, deleted: bool) -> int:
        return self._add_dealt(self._dealt(rows, old).drop(SLICE), old, deleted)

    def _add_dealt(self, rows: DataFrame, old: _Manifest, deleted: bool) -> int:
        """Commit rows, dealt by bucket, as a delta."""
        number = old.number + 1
        marked = rows.withColumns({VERSION: F.lit(number).cast("long"), DELETED: F.lit(deleted)})
        parts = {b: list(p) for b, p in old.parts.items()}
        for bucket, folder in self._write(marked, old).items():
            parts.setdefault(bucket, []).append([number, folder])
        return self._commit(old.next(parts))

    def replace(self, rows: DataFrame, **partition) -> int:
        """Put ``rows`` in place of a whole partition, also if there are none: readers see the old or the new rows."""
        old = self.manifest()
        if set(partition) != set(old.partition_by):
            raise ValueError(f"{self.path} is partitioned by {old.partition_by}; values were given for {sorted(partition)}")
        number, names = old.number + 1, self._schema(old).fieldNames()
        rows = self._dealt(rows.select(*names).filter(_is_partition(partition)), old).dropDuplicates([*old.partition_by, BUCKET, SLICE, self.key])
        marked = rows.drop(SLICE).withColumns({VERSION: F.lit(number).cast("long"), DELETED: F.lit(False)})
        new = self._write(marked, old)
        parts = {b: list(p) for b, p in old.parts.items() if not self._inside(b, partition)}
        return self._commit(old.next(parts | {b: [[number, f]] for b, f in new.items()}))

    def compact(self, least_deltas: int = 4) -> int:
        """Rewrite the buckets that have so many deltas, each to one base of its current rows."""
        old = self.manifest()
        chosen = [b for b, p in old.parts.items() if len(p) > least_deltas]
        if not chosen:
            return old.number
        number = old.number + 1
        marked = self._dealt(self._merged(old, chosen), old).drop(SLICE).withColumns({VERSION: F.lit(number).cast("long"), DELETED: F.lit(False)})
        new = self._write(marked, old)
        parts = {b: list(p) for b, p in old.parts.items() if b not in chosen} | {b: [[number, f]] for b, f in new.items()}
        return self._commit(old.next(parts))

    def vacuum(self) -> None:
        """Delete earlier versions and the files that only they have; readers of these must be done."""
        current = self.manifest()
        used = {f for p in current.parts.values() for _, f in p}
        for kind in ("data", "filters"):
            for name in self._names(f"{self.path}/{kind}"):
                if name not in used:
                    jpath, fs = self._fs(f"{self.path}/{kind}/{name}")
                    fs.delete(jpath, True)
        for number in self.versions()[:-1]:
            jpath, fs = self._fs(f"{self.path}/manifests/m{number:010d}.json")
            fs.delete(jpath, False)

    # Reading

    def _schema(self, manifest: _Manifest) -> StructType:
        return StructType.fromJson(json.loads(manifest.schema))

    def _inside(self, bucket: str, partition: dict) -> bool:
        """Whether a bucket folder lies in the partition; values are compared as Spark names folders."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return set(f"{k}={escape(str(v))}" for k, v in partition.items()) <= set(bucket.split("/"))

    def _files(self, manifest: _Manifest, folders: list[str]) -> DataFrame:
        schema = self._schema(manifest).add(BUCKET, IntegerType()).add(VERSION, LongType()).add(DELETED, BooleanType())
        if not folders:
            return self.spark.createDataFrame([], schema)
        # Folders of several commits have no common base for partition discovery, so each commit is read by itself.
        commits: dict[str, list[str]] = {}
        for f in folders:
            commits.setdefault(f.split("/")[0], []).append(f"{self.path}/data/{f}")
        frames = [self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{c}").parquet(*paths) for c, paths in commits.items()]
        out = frames[0]
        for more in frames[1:]:
            out = out.unionByName(more)
        return out

    def _merged(self, manifest: _Manifest, buckets: list[str]) -> DataFrame:
        """The current rows of some buckets. Of a base, only the ids that deltas hold are looked at twice."""
        names = self._schema(manifest).fieldNames()
        by = [*manifest.partition_by, self.key]
        single = [f"{p[0][1]}/{b}" for b in buckets if len(p := manifest.parts[b]) == 1]
        first = [f"{p[0][1]}/{b}" for b in buckets if len(p := manifest.parts[b]) > 1]
        later = [f"{folder}/{b}" for b in buckets for _, folder in manifest.parts[b][1:]]
        whole = self._files(manifest, single).filter(~F.col(DELETED)).select(*names)
        if not later:
            return whole
        last = F.max_by(F.struct(DELETED, *[c for c in names if c not in by]), VERSION)
        deltas = self._files(manifest, later).groupBy(*by).agg(last.alias("_row")).select(*by, "_row.*")
        base = self._files(manifest, first).filter(~F.col(DELETED)).select(*names)
        same = [base[c].eqNullSafe(deltas[c]) for c in by]
        kept = base.join(deltas.select(*by), on=_all(same), how="left_anti")
        return whole.unionByName(kept.select(*names)).unionByName(deltas.filter(~F.col(DELETED)).select(*names))

    def read(self, version: int | None = None, **partition) -> DataFrame:
        """The current rows, or those of a version; of one partition if its values are given."""
        manifest = self.manifest(version)
        return self._merged(manifest, [b for b in manifest.parts if self._inside(b, partition)])

    def fetch(self, ids: DataFrame, **partition) -> DataFrame:
        """The rows of some ids, from their buckets only."""
        manifest = self.manifest()
        wanted = self._bucketed(ids.select(self.key).distinct(), manifest.n_buckets)
        touched = {r[0] for r in wanted.select(BUCKET).distinct().collect()}  # at most ``n_buckets`` numbers
        buckets = [b for b in manifest.parts if _number(b) in touched and self._inside(b, partition)]
        return self._merged(manifest, buckets).join(wanted.select(self.key), self.key, "left_semi").select(*self._schema(manifest).fieldNames())

    def only_new(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose (partition columns, id) are not stored.

        The filters are asked first. What they don't know is new for sure; only
        the rest is looked up, in its buckets. So a batch of new ids
        neither reads nor shuffles the table.
        """
        manifest = self.manifest()
        by = [*manifest.partition_by, self.key]
        keys = materialise(self._bucketed(batch.select(*by).distinct(), manifest.n_buckets), "batch-ids")
        maybe = materialise(self._maybe_stored(keys, manifest), "maybe-stored")
        touched = {r[0] for r in maybe.select(BUCKET).distinct().collect()}
        if not touched:
            return batch
        stored = self._merged(manifest, [b for b in manifest.parts if _number(b) in touched]).select(*by)
        known = maybe.join(stored.withColumn("_there", F.lit(True)), on=_all([maybe[c].eqNullSafe(stored[c]) for c in by]), how="left_semi").select(*by)
        return batch.join(known, on=_all([batch[c].eqNullSafe(known[c]) for c in by]), how="left_anti")

    def _maybe_stored(self, keys: DataFrame, manifest: _Manifest) -> DataFrame:
        """The keys that a filter of their bucket knows: all that are stored, and a few more."""
        live = [(folder, b, _number(b)) for b, p in manifest.parts.items() for _, folder in p]
        if not live:
            return keys.limit(0)
        if not manifest.filters:
            return keys
        names = sorted({f for f, _, _ in live})
        read = self.spark.read.schema("folder string, bits binary").parquet(*[f"{self.path}/filters/{n}" for n in names])
        read = read.select(F.regexp_extract(F.col("_metadata.file_path"), "filters/([^/]*)/", 1).alias("commit"), "folder", "bits")
        alive = self.spark.createDataFrame(live, "commit string, folder string, bucket int")
        filters = read.join(F.broadcast(alive), ["commit", "folder"]).select(F.col("bucket").alias(BUCKET), "bits")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema)
        return keys.groupby(BUCKET).cogroup(filters.groupby(BUCKET)).applyInArrow(_known(self.key), schema)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _is_partition(partition: dict) -> Column:
    return _all([F.lit(True), *[F.col(k) == v for k, v in partition.items()]])


def _number(bucket: str) -> int:
    return int(bucket.rsplit("=", 1)[1])


def _places(ids: pa.ChunkedArray, bits: int) -> np.ndarray:
    """(ids, hashes) places in a filter of ``bits`` bits, a power of two."""
    import xxhash

    texts = ids.cast(pa.string()).to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(t or "") for t in texts], np.uint64)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes[:, None] + np.arange(ID_HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _filter_of(key: str):
    def work(name, ids):
        bits = 1 << max(int(ID_BITS * ids.num_rows - 1).bit_length(), 10)
        out = np.zeros(bits, bool)
        for start in range(0, ids.num_rows, _IDS_AT_ONCE):
            out[_places(ids.column(key).slice(start, _IDS_AT_ONCE), bits).ravel()] = True
        return pa.table({"folder": pa.array([name[0].as_py()], pa.string()), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    return work


def _known(key: str):
    def work(keys: pa.Table, filters: pa.Table) -> pa.Table:
        known = np.zeros(keys.num_rows, bool)
        for packed in filters.column("bits") if keys.num_rows else ():
            table = np.frombuffer(packed.as_buffer(), np.uint8)
            for start in range(0, keys.num_rows, _IDS_AT_ONCE):
                at = _places(keys.column(key).slice(start, _IDS_AT_ONCE), 8 * len(table))
                known[start : start + len(at)] |= ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
        return keys.filter(pa.array(known, pa.bool_()))

    return work
