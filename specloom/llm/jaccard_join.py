"""N-gram Jaccard join by token-combination prefixes, and its classes of near duplicates.

A document's set holds a 64-bit hash of each distinct run of five words. Two
documents link when 100 * |common| >= 75 * |union|. Exact: nothing is sampled
and no posting list is cut.

1. Equal sets form a class; only one set of a class goes on.
2. In the order of their hashes, two linked sets share at least k items of
   their first ``size - least overlap + k``. A set that shares fewer than k
   items of that prefix with any other set links with nothing and is put aside.
3. For the sets that remain, items are ordered by document frequency. Items in
   up to ``rare`` sets are *rare* and are keys by themselves. Frequent ones are
   dealt to subclasses (more of them for larger sets) and the keys are the
   pairs of items within a subclass. The prefix is extended until more items
   than may be missing would have to be missing for two sets to share no key.
   The smaller of two linked sets shares a key of its *short* prefix with the
   other's *long* one.
4. First, one partner for each set (of the sets of a key with the fewest items
   of their own, the one with most keys in common) is verified and linked sets
   are merged. So copies by the thousand cost a link each, not all pairs.
5. Then every key is looked at again, and sets of different components that
   share one, and that sizes and sketches of 128 bits leave possible, are joined to
   clusters. A bucket puts out a forest of them, not the pairs.
6. The sets of a cluster meet, in blocks of bounded size, and their items are
   counted against each other there. A block puts out a forest of the links.

Items are compared by 64-bit hashes, so results are exact up to collisions of these.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from specloom.llm import textkernel as K
from specloom.llm.components import connected_components
from specloom.llm.exchange import U64, bucket_of, exchanged, pack, packed_schema
from specloom.operators.keys import split_hot_keys
from specloom.session import materialise

WORDS = 5
RARE = 32
# Sets per subclass pair: about this many items of a whole set fall into one subclass.
SUBCLASS_ITEMS = 8
# Bits of a set's sketch.
SKETCH = 128
# Pairs that one reducer holds before it cuts them down to a forest.
PAIR_BLOCK = 1_000_000
# Sets of a cluster that meet at once.
BLOCK_SETS = 4096
# Packed bytes that a reducer is to take; its arrays are several times as large.
BUCKET_BYTES = 32_000_000
# Bits of the filter for documents whose sets are candidates: at most this many, so its size does not grow with the data.
FILTER_BITS = 2**29
# Sets of a key that are tried as partners of its other sets before all pairs of different components are.
PARTNERS = 3


def _ceil_percent(n, percent: int):
    return -(-(n * percent) // 100)


def least_overlap(n, percent: int):
    """Items of a set of n that any linked set must have."""
    return _ceil_percent(n, percent)


def least_overlap_with_larger(n, percent: int):
    """Items of a set of n that a linked set of at least n items must have."""
    return -(-(2 * percent * n) // (100 + percent))


def _extra(n):
    """k of the first prefix: a set shares this many prefix items, not only one."""
    return _ceil_percent(n, 15)


def bands(percent: int, top: int = 2**40) -> np.ndarray:
    """Sizes at which bands begin; linked sets lie in one band or in neighbours."""
    edges = [1]
    while edges[-1] < top:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return np.array(edges)


def shingle_sets(batch: pa.RecordBatch, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    data, offsets = K.text_buffer(batch.column("text"))
    data = K.LOWER[data]
    starts, ends, doc = K.word_spans(data, offsets)
    hashes = K.span_hashes(data, starts, ends)
    grams = K.ngram_hashes(hashes, words)
    ok = K.same_text(doc, words)
    grams, gram_doc = grams[ok], doc[: len(ok)][ok]
    word_cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    gram_cut = np.searchsorted(gram_doc, np.arange(batch.num_rows + 1))
    sets = []
    for i in range(batch.num_rows):
        n_words = word_cut[i + 1] - word_cut[i]
        if n_words >= words:
            own = grams[gram_cut[i] : gram_cut[i + 1]].copy()
            own.sort()
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n_words:
            sets.append(K.ngram_hashes(hashes[word_cut[i] : word_cut[i + 1]], int(n_words)))
        else:
            sets.append(np.zeros(0, U64))
    return sets


def _signature(items: np.ndarray) -> tuple[int, int]:
    """Two independent hashes of a set."""
    a, b = K.mix(items).sum(dtype=U64), K.mix(items ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
    both = K.mix(np.array([a, b], U64))
    return int(both.view(np.int64)[0]), int(both.view(np.int64)[1])


def _sizes(batches):
    for part in K.text_slices(batches):
        sets = shingle_sets(part)
        signs = [_signature(s) for s in sets]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "a": pa.array([x for x, _ in signs], pa.int64()),
                "b": pa.array([x for _, x in signs], pa.int64()),
            }
        )


def _first_prefixes(n_buckets: int, percent: int):
    def work(batches):
        for part in K.text_slices(batches):
            items, owner, signs = [], [], []
            for s in shingle_sets(part):
                n = len(s)
                if n:
                    head = s[: n - least_overlap(n, percent) + _extra(n)]
                    items.append(head)
                    owner.append(np.full(len(head), len(signs)))
                    signs.append(_signature(s)[0])
            if items:
                items = np.concatenate(items)
                yield pack(
                    _spread(items, n_buckets), np.concatenate(owner), {"sign": np.array(signs, np.int64)}, {"item": items}
                )

    return work


def _spread(items: np.ndarray, n: int) -> np.ndarray:
    """Buckets by another hash: the prefixes hold small hashes only."""
    return bucket_of(K.mix(items), n)


def _shared_counts(n_buckets: int):
    """(sign, shared): how many of a set's items of this bucket other sets have too; packed by sign."""

    def reduce(arrays):
        order = np.lexsort((arrays["sign"], arrays["item"]))
        item, sign = arrays["item"][order], arrays["sign"][order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (sign[1:] != sign[:-1])
        item, sign = item[new], sign[new]
        first, length = K.runs(item)
        sign = sign[np.repeat(length > 1, length)]
        if len(sign):
            sign, shared = np.unique(sign, return_counts=True)
            where = bucket_of(K.mix(sign.view(U64)), n_buckets)
            yield pack(where, np.arange(len(sign)), {"sign": sign}, {"shared": shared.astype(np.uint32)})

    return reduce


def _summed(arrays):
    sign, inverse = np.unique(arrays["sign"], return_inverse=True)
    shared = np.bincount(inverse, weights=arrays["shared"], minlength=len(sign)).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"a": pa.array(sign), "shared": pa.array(shared)})


def _filter_places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of a Bloom filter that each id sets."""
    h = K.mix(ids.view(U64))
    return [(K.mix(h + U64(k)) & U64(bits - 1)).astype(np.int64) for k in range(3)]


def _filter_words(bits: int):
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                places = np.unique(np.concatenate(_filter_places(batch.column("doc_id").to_numpy(), bits)))
                word, inverse = np.unique(places >> 6, return_inverse=True)
                value = np.zeros(len(word), U64)
                np.bitwise_or.at(value, inverse, U64(1) << (places & 63).astype(U64))
                yield pa.RecordBatch.from_pydict({"word": pa.array(word), "value": pa.array(value.view(np.int64))})

    return work


def candidate_filter(candidates: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the ``n`` candidates' ids, of 16 bits for each and ``FILTER_BITS`` at most.

    It only spares texts a shuffle: where it is crowded, more sets than needed go on to the exact join.
    """
    bits = min(1 << max(int(16 * n - 1).bit_length(), 10), FILTER_BITS)
    words = candidates.select("doc_id").mapInArrow(_filter_words(bits), "word long, value long")
    out = np.zeros(bits >> 6, U64)
    for r in words.groupBy("word").agg(F.bit_or("value").alias("value")).toLocalIterator():
        out[r.word] = np.int64(r.value).view(U64)
    return out


def _candidate_sets(sent):
    """The whole sets of the documents that pass the filter."""

    def work(batches):
        for batch in batches:
            table = sent.value
            ids = batch.column("doc_id").to_numpy()
            keep = np.ones(len(ids), bool)
            for place in _filter_places(ids, len(table) << 6):
                keep &= (table[place >> 6] >> (place & 63).astype(U64)) & U64(1) > 0
            for part in K.text_slices([batch.filter(pa.array(keep))]):
                sets = shingle_sets(part)
                signs = [_signature(s) for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "a": pa.array([x for x, _ in signs], pa.int64()),
                        "b": pa.array([x for _, x in signs], pa.int64()),
                        "items": pa.array([s.tobytes() for s in sets], pa.binary()),
                    }
                )

    return work


def _all_items(n_buckets: int):
    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sets = [np.frombuffer(x, U64) for x in part.column("items").to_pylist()]
                items = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                runs = {k: part.column(k).to_numpy().astype(np.int64) for k in ("doc", "n")}
                yield pack(_spread(items, n_buckets), owner, runs, {"item": items})

    return work


def _frequencies(n_buckets: int):
    """The items of this bucket that several sets have, with their frequency; packed by set."""

    def reduce(arrays):
        order = np.lexsort((arrays["doc"], arrays["item"]))
        item, doc, n = arrays["item"][order], arrays["doc"][order], arrays["n"][order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
        item, doc, n = item[new], doc[new], n[new]
        first, length = K.runs(item)
        many = np.repeat(length > 1, length)
        df = np.repeat(length, length)[many].astype(np.uint32)
        item, doc, n = item[many], doc[many], n[many]
        order = np.argsort(doc, kind="stable")
        item, df, doc, n = item[order], df[order], doc[order], n[order]
        if len(doc):
            first, length = K.runs(doc)
            run = np.repeat(np.arange(len(first)), length)
            where = bucket_of(K.mix(doc.view(U64)), n_buckets)
            yield pack(where, run, {"doc": doc[first], "n": n[first]}, {"item": item, "df": df})

    return reduce


def _sketch(items: np.ndarray) -> np.ndarray:
    """Bits that are each the parity of the items that fall on it: two sets differ in at least as many items as bits."""
    odd = np.bincount((K.mix(items ^ U64(0x5EED)) & U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _profiles(arrays):
    """(doc, n, items, df, sketch): each set's shared items, sorted by hash."""
    order = np.lexsort((arrays["item"], arrays["doc"]))
    a = {k: v[order] for k, v in arrays.items()}
    first, length = K.runs(a["doc"])
    for at in range(0, len(first), 5_000):
        cuts = [(int(x), int(x + y)) for x, y in zip(first[at : at + 5_000], length[at : at + 5_000])]
        yield pa.RecordBatch.from_pydict(
            {
                "doc": pa.array(a["doc"][first[at : at + 5_000]]),
                "n": pa.array(a["n"][first[at : at + 5_000]]),
                "items": pa.array([a["item"][x:y].tobytes() for x, y in cuts], pa.binary()),
                "df": pa.array([a["df"][x:y].tobytes() for x, y in cuts], pa.binary()),
                "sketch": pa.array([_sketch(a["item"][x:y]).tobytes() for x, y in cuts], pa.binary()),
            }
        )


def set_keys(
    n: int, items: np.ndarray, df: np.ndarray, percent: int, edges: np.ndarray, rare: int = RARE
) -> tuple[np.ndarray, np.ndarray]:
    """The keys of one set and whether each is in its short prefix.

    ``items`` are those that other sets have too; the other ``n - len(items)``
    come first in every order and only use up what may be missing.
    """
    single = n - len(items)
    long_miss = n - least_overlap(n, percent)
    short_miss = n - least_overlap_with_larger(n, percent)
    if single > long_miss:
        return np.zeros(0, U64), np.zeros(0, bool)
    order = np.lexsort((items, df))
    items, df = items[order], df[order]
    n_rare = int(np.searchsorted(df, rare, "right"))
    take = min(n_rare, long_miss + 1 - single)
    keys = [K.mix(items[:take])]
    short = [single + np.arange(1, take + 1) <= short_miss + 1]
    if single + n_rare <= long_miss:
        common = items[n_rare:]
        band = int(np.searchsorted(edges, n, "right")) - 1
        for b in (band, band + 1):
            classes = max(1, int(edges[b]) // SUBCLASS_ITEMS)
            part = (K.mix(common) % U64(classes)).astype(np.int64)
            counts = np.ones(len(common), bool)
            counts[np.unique(part, return_index=True)[1]] = False
            # Items of the order up to here that would have to be missing for no common key.
            must = single + n_rare + np.cumsum(counts)
            end = min(int(np.searchsorted(must, long_miss + 1)) + 1, len(common))
            groups = defaultdict(list)
            for i, p in enumerate(part[:end].tolist()):
                groups[p].append(i)
            left, right = [], []
            for members in groups.values():
                for j in range(1, len(members)):
                    right += [members[j]] * j
                    left += members[:j]
            if right:
                left, right = np.array(left), np.array(right)
                keys.append(K.mix(common[left] * U64(3) + K.mix(common[right] + U64(b))))
                before = np.concatenate(([single + n_rare], must[:-1]))
                short.append(before[right] <= short_miss)
    return np.concatenate(keys), np.concatenate(short)


def _keyed(n_buckets: int, percent: int, every: int, rare: int):
    """Deal the keys of the sets; of one in ``every`` keys only, in the first round."""
    edges = bands(percent)

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys, short, owner = [], [], []
                columns = [part.column(c).to_pylist() for c in ("n", "items", "df")]
                for i, (n, items, df) in enumerate(zip(*columns)):
                    key, head = set_keys(n, np.frombuffer(items, U64), np.frombuffer(df, np.uint32), percent, edges, rare)
                    if every > 1:
                        head, key = head[key % U64(every) == 0], key[key % U64(every) == 0]
                    keys.append(key)
                    short.append(head)
                    owner.append(np.full(len(key), i))
                key = np.concatenate(keys)
                if len(key):
                    runs = {k: part.column(k).to_numpy().astype(RUNS[k]) for k in ("doc", "n", "component")}
                    runs["single"] = runs["n"] - np.array([len(x) // 8 for x in columns[1]], RUNS["n"])
                    sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.int64).reshape(part.num_rows, -1)
                    runs |= {k: sketches[:, i] for i, k in enumerate(WORDS_OF_SKETCH)}
                    items = {"key": key, "short": np.concatenate(short).astype(np.uint8)}
                    runs = {k: runs[k] for k in RUNS}  # in the schema's order
                    yield pack(bucket_of(key, n_buckets), np.concatenate(owner), runs, items)

    return work


WORDS_OF_SKETCH = [f"s{i}" for i in range(SKETCH // 64)]
RUNS = {"doc": np.int64, "component": np.int64, "n": np.int32, "single": np.int32} | dict.fromkeys(WORDS_OF_SKETCH, np.int64)
ITEMS = {"key": U64, "short": np.uint8}


def _by_key(arrays):
    """Sorted by key, the sets with the fewest items of their own first."""
    order = np.lexsort((arrays["doc"], arrays["single"] / arrays["n"], arrays["key"]))
    a = {k: v[order] for k, v in arrays.items()}
    new = np.ones(len(order), bool)
    new[1:] = (a["key"][1:] != a["key"][:-1]) | (a["doc"][1:] != a["doc"][:-1])
    return {k: v[new] for k, v in a.items()}


def _may_link(a, left, right, percent: int):
    """Sizes and sketches allow a link, and the smaller set has the key in its short prefix."""
    n_left, n_right = a["n"][left].astype(np.int64), a["n"][right].astype(np.int64)
    head_left, head_right = a["short"][left] > 0, a["short"][right] > 0
    head = np.where(n_left < n_right, head_left, head_right)
    head = np.where(n_left == n_right, head_left | head_right, head)
    may = (a["component"][left] != a["component"][right]) & head
    may &= 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    some = np.flatnonzero(may)
    left, right = left[some], right[some]
    differ = a["single"][left].astype(np.int64) + a["single"][right]
    for word in WORDS_OF_SKETCH:
        differ += np.bitwise_count((a[word][left] ^ a[word][right]).view(U64))  # of signed numbers it counts another thing
    # common <= (size of both - differing items) / 2
    both = n_left[some] + n_right[some]
    may[some] = 100 * (both - differ) >= percent * (both + differ)
    return may


def _partners(percent: int):
    """(doc, partner, shared): the most typical sets of each key as partners of the others."""

    def reduce(arrays):
        a = _by_key(arrays)
        first, length = K.runs(a["key"])
        found = []
        for k in range(PARTNERS):
            pivot = np.repeat(np.where(length > k, first + k, first), length)
            own = np.arange(len(pivot))
            keep = own > pivot
            keep[keep] = _may_link(a, pivot[keep], own[keep], percent)
            found.append(np.stack([a["doc"][own[keep]], a["doc"][pivot[keep]]]))
        pairs, shared = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
        # The best of each set, here.
        order = np.lexsort((-shared, pairs[0]))
        pairs, shared = pairs[:, order], shared[order]
        best = K.runs(pairs[0])[0]
        yield pa.RecordBatch.from_pydict(
            {"doc": pa.array(pairs[0][best]), "partner": pa.array(pairs[1][best]), "shared": pa.array(shared[best])}
        )

    return reduce


def _open_clusters(percent: int):
    """(doc, partner): a forest over the sets of different components that share a key and may link.

    Sets of a key that are joined already, by way of others, aren't compared again.
    """

    def reduce(arrays):
        a = _by_key(arrays)
        first, length = K.runs(a["key"])
        low = np.minimum.reduceat(a["component"], first) if len(first) else first
        high = np.maximum.reduceat(a["component"], first) if len(first) else first
        found, held = [], 0
        for at, n in zip(first[low < high].tolist(), length[low < high].tolist()):
            label, docs = np.arange(n), a["doc"][at : at + n]
            for i in range(n - 1):
                right = np.flatnonzero(label != label[i])
                right = right[right > i]
                keep = right[_may_link(a, np.full(len(right), at + i), at + right, percent)] if len(right) else right
                if len(keep):
                    joined, one = np.unique(label[keep], return_index=True)
                    found.append(np.stack([docs[keep[one]], np.full(len(one), docs[i])]))
                    held += len(one)
                    label[np.isin(label, joined)] = label[i]
            if held >= PAIR_BLOCK:
                found = [_forest(np.concatenate(found, axis=1))]
                held = found[0].shape[1]
        if found:
            pairs = _forest(np.concatenate(found, axis=1))
            yield pa.RecordBatch.from_pydict({"doc": pa.array(pairs[0]), "partner": pa.array(pairs[1])})

    return reduce


def _forest(pairs: np.ndarray) -> np.ndarray:
    """(2, n) pairs to (node, smallest node reachable), without the smallest ones themselves."""
    nodes, ends = np.unique(pairs, return_inverse=True)
    left, right = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(new, root[left], least)
        np.minimum.at(new, root[right], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]])


def _links_in_block(percent: int):
    """(doc, partner): a forest of the links between sets of different components of one block."""

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            doc, n, component = (right.column(c).to_numpy() for c in ("doc", "n", "component"))
            sets = [np.frombuffer(x, U64) for x in right.column("items").to_pylist()]
            item, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            order = np.argsort(item, kind="stable")
            item, owner, label = item[order], owner[order], np.arange(len(sets))
            for one, size, own, items in zip(*(left.column(c).to_pylist() for c in ("doc", "n", "component", "items"))):
                open_ = (doc > one) & (component != own) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
                if not open_.any():
                    continue
                items = np.frombuffer(items, U64)
                begin, end = np.searchsorted(item, items), np.searchsorted(item, items, "right")
                total = end - begin
                where = np.arange(total.sum()) + np.repeat(begin - np.cumsum(total) + total, total)
                common = np.bincount(owner[where], minlength=len(sets))
                linked = np.flatnonzero(open_ & (100 * common >= percent * (n + size - common)))
                if len(linked):
                    # One link to each of the sets that earlier links haven't joined.
                    joined, first = np.unique(label[linked], return_index=True)
                    found += [(int(doc[x]), one) for x in linked[first]]
                    label[np.isin(label, joined)] = joined[0]
        return pa.table({"doc": pa.array([x for x, _ in found], pa.int64()), "partner": pa.array([x for _, x in found], pa.int64())})

    return links


def linked_in_clusters(edges: DataFrame, merged: DataFrame, percent: int, block_sets: int = BLOCK_SETS) -> DataFrame:
    """(doc, partner): links between sets (doc, n, items, component) that ``edges`` bring into one cluster.

    Enough of them to connect what is linked. A cluster's sets are dealt to a
    grid of blocks of up to ``block_sets``.
    """
    clusters = connected_components(edges.toDF("a", "b")).withColumnRenamed("node", "doc").withColumnRenamed("component", "cluster")
    sets = materialise(clusters.join(merged.select("doc", "n", "items", "component"), "doc"), "jaccard-open-sets")
    right = sets.select(*[F.col(c).alias(c) for c in sets.columns])
    left, right, cells = split_hot_keys(sets, right, ["cluster"], ["doc"], ["doc"], block_sets, block_sets)
    return left.groupby(*cells).cogroup(right.groupby(*cells)).applyInArrow(_links_in_block(percent), "doc long, partner long")


def _verify(percent: int):
    def work(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n", "items", "partner_n", "partner_items")]
            keep = []
            for i, (n, items, m, others) in enumerate(zip(*columns)):
                common = len(np.intersect1d(np.frombuffer(items, U64), np.frombuffer(others, U64), assume_unique=True))
                if 100 * common >= percent * (n + m - common):
                    keep.append(i)
            yield batch.select(["doc", "partner"]).take(pa.array(keep, pa.int64()))

    return work


def verified(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs (doc, partner) that link, by their whole sets."""
    others = profiles.select(
        F.col("doc").alias("partner"), F.col("n").alias("partner_n"), F.col("items").alias("partner_items")
    )
    both = pairs.join(profiles.select("doc", "n", "items"), "doc").join(others, "partner")
    return both.select("doc", "n", "items", "partner", "partner_n", "partner_items").mapInArrow(
        _verify(percent), "doc long, partner long"
    )


def buckets_for(sets: DataFrame, item_bytes: float) -> int:
    """Buckets for the items of ``sets`` (n), so that one gets about ``BUCKET_BYTES``."""
    items = sets.agg(F.sum("n")).first()[0] or 0
    return int(items * item_bytes // BUCKET_BYTES) + 1


def jaccard_classes(documents: DataFrame, percent: int = 75, rare: int = RARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``documents`` (doc_id, text, ...).

    component_id is the smallest doc_id reachable by links. Null or blank texts
    have an empty set, link with nothing and are their own component. Rows
    without a doc_id keep null as their id; they count towards nothing and
    take the component of an equal set, if there is one. Repeated rows come
    out as often as they came in. Other columns are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = materialise(docs.mapInArrow(_sizes, "doc_id long, n long, a long, b long"), "jaccard-sizes")
    # A prefix is two fifths of a set; an item takes twice its 8 bytes.
    n_buckets = buckets_for(sizes, 16 * 0.4)
    classes = sizes.filter("n > 0 and doc_id is not null").groupBy("a", "b", "n").agg(F.min("doc_id").alias("doc_id"))

    first = docs.filter("text is not null and doc_id is not null").mapInArrow(
        _first_prefixes(n_buckets, percent), packed_schema({"sign": 0}, {"item": 0})
    )
    shared = exchanged(
        first, {"sign": np.int64}, {"item": U64}, _shared_counts(n_buckets), packed_schema({"sign": 0}, {"shared": 0}), n_buckets=n_buckets
    )
    shared = exchanged(shared, {"sign": np.int64}, {"shared": np.uint32}, _summed, "a long, shared long", n_buckets=n_buckets)
    least = f"ceil(ceil(n * {percent} / 100) * 15 / 100)"
    candidates = materialise(
        classes.join(shared, "a").filter(f"shared >= {least}").select("doc_id", "a", "b", "n"), "jaccard-candidates"
    )
    passing = docs.sparkSession.sparkContext.broadcast(candidate_filter(candidates, candidates.count()))
    whole = docs.filter("text is not null and doc_id is not null").mapInArrow(_candidate_sets(passing), "doc_id long, a long, b long, items binary")
    # Repeated rows are still in here; where items meet, a set counts once.
    sets = candidates.join(whole, ["doc_id", "a", "b"]).select(F.col("doc_id").alias("doc"), "n", "items")
    n_buckets = buckets_for(candidates, 20)

    runs = {"doc": np.int64, "n": np.int64}
    profiles = exchanged(
        sets.mapInArrow(_all_items(n_buckets), packed_schema(runs, {"item": 0})),
        runs,
        {"item": U64},
        _frequencies(n_buckets),
        packed_schema(runs, {"item": 0, "df": 0}),
        n_buckets=n_buckets,
    )
    schema = "doc long, n long, items binary, df binary, sketch binary"
    profiles = exchanged(profiles, runs, {"item": U64, "df": np.uint32}, _profiles, schema, n_buckets=n_buckets)
    profiles = materialise(profiles, "jaccard-profiles")

    def keys(components: DataFrame, every: int) -> DataFrame:
        return components.mapInArrow(_keyed(n_buckets, percent, every, rare), packed_schema(RUNS, ITEMS))

    merged = profiles.withColumn("component", F.col("doc"))
    found = exchanged(keys(merged, 4), RUNS, ITEMS, _partners(percent), "doc long, partner long, shared long", n_buckets=n_buckets)
    pairs = found.groupBy("doc").agg(F.max_by("partner", F.struct("shared", -F.col("partner"))).alias("partner"))
    links = materialise(verified(materialise(pairs, "jaccard-pairs"), profiles, percent), "jaccard-links")
    merged = profiles.join(connected_components(links.toDF("a", "b")).withColumnRenamed("node", "doc"), "doc", "left")
    merged = materialise(merged.withColumn("component", F.coalesce("component", "doc")), "jaccard-merged")
    edges = exchanged(keys(merged, 1), RUNS, ITEMS, _open_clusters(percent), "doc long, partner long", n_buckets=n_buckets)
    links = links.unionByName(linked_in_clusters(materialise(edges, "jaccard-edges"), merged, percent))

    components = connected_components(links.toDF("a", "b"))
    named = classes.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = named.select("a", "b", "n", F.coalesce("component", "doc_id").alias("component_id"))
    return sizes.join(named, ["a", "b", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
