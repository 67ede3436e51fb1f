"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy search in it.

Equal vectors are one node of the graph, so thousands of copies cost one.

Building: in several random partitions (the signs of random projections, dealt
on where a cell is too full), every node is compared with its cell. Then, in
each round, all neighbours of a node, in either direction, meet as neighbours
of neighbours: those that are nearer to each other than what they have become
neighbours. The meeting is a Spark shuffle by the node in the middle.

Searching: a query begins at its own node, if it has one, and at ``ENTRIES`` nodes spread over all; in each
round the best nodes that weren't expanded yet are, for all queries of a block
at once: Spark brings requests to nodes, their neighbours to the vectors, and
scores back to the queries. What is found best is scored again exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64, bucket_count, bucket_of, exchanged, joined, pack, packed_schema
from specloom.session import materialise

NEIGHBOURS = 24
PARTITIONS = 8
CELL = 512
ROUNDS = 3
# What a pair of neighbours may offer each of them, at most, per middle node: the best.
OFFERS = 6
# Search: nodes that a query expands in a round, rounds, and nodes it keeps in sight.
EXPAND = 96
SEARCH_ROUNDS = 6
BEAM = 1_000
ENTRIES = 64
QUERY_BLOCK = 4_096
NODES = "node long, vec binary, near binary, sims binary"


def _cosine_ready(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id and a finite vector that isn't zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("v", lambda x: x != 0))


def _where(nodes: np.ndarray, n: int) -> np.ndarray:
    return bucket_of(K.mix(nodes.view(U64)), n)


def _units(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return (values / np.linalg.norm(values, axis=1, keepdims=True)).astype(np.float32)


def _celled(n_buckets: int, dimensions: int, bits: int, spread: int):
    """Deal the nodes to the cells of each random partition."""
    planes = np.random.default_rng(11).standard_normal((PARTITIONS, dimensions, bits)).astype(np.float32)

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node, unit = batch.column("id").to_numpy(), _units(batch)
            for p in range(PARTITIONS):
                sign = (unit @ planes[p] > 0) @ (1 << np.arange(bits))
                part = (K.mix(node.view(U64) + U64(p)) % U64(spread)).astype(np.int64)
                cell = K.mix((sign * spread + part).astype(U64) + U64(p << 48))
                items = {"cell": cell, "node": node, "vec": unit}
                yield pack(bucket_of(cell, n_buckets), np.arange(len(node)), {"run": node}, items)

    return work


def _cell_neighbours(dimensions: int, n_buckets: int, k: int):
    def reduce(a):
        vec = a["vec"].reshape(-1, dimensions)
        order = np.lexsort((a["node"], a["cell"]))
        first, length = K.runs(a["cell"][order])
        for at, n in zip(first.tolist(), length.tolist()):
            # A cell that is too full is cut where the nodes lie along a random line.
            own = order[at : at + n]
            pieces = -(-n // (2 * CELL))
            if pieces > 1:
                line = np.random.default_rng(int(n)).standard_normal(dimensions).astype(np.float32)
                own = own[np.argsort(vec[own] @ line, kind="stable")]
            for piece in np.array_split(own, pieces):
                yield from _best_offers(a["node"][piece], vec[piece], np.full(len(piece), -2.0, np.float32), k, n_buckets)

    return reduce


def _best_offers(node, vec, least, k: int, n_buckets: int):
    """Each node's k nearest of the others, if nearer than ``least``; packed by node."""
    if len(node) < 2:
        return
    sims = vec @ vec.T
    np.fill_diagonal(sims, -3.0)
    k = min(k, len(node) - 1)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    got = np.take_along_axis(sims, near, axis=1)
    ok = got > least[:, None]
    to = np.repeat(node, k).reshape(-1, k)[ok]
    if len(to):
        yield {"to": to, "other": node[near[ok]], "sim": got[ok].astype(np.float32)}


def _packed_offers(reduce, n_buckets: int):
    """Gather a reducer's offers into few rows."""

    def work(a):
        held, size = [], 0
        for offer in reduce(a):
            held.append(offer)
            size += len(offer["to"])
            if size > 500_000:
                yield _offers(held, n_buckets)
                held, size = [], 0
        if held:
            yield _offers(held, n_buckets)

    return work


def _offers(held: list[dict], n_buckets: int) -> pa.RecordBatch:
    a = {k: np.concatenate([h[k] for h in held]) for k in ("to", "other", "sim")}
    return _fill(pack(_where(a["to"], n_buckets), np.arange(len(a["to"])), {"run": a["to"]}, a), MERGE)


OFFER = {"to": np.int64, "other": np.int64, "sim": np.float32}
OWN = {"node": np.int64, "vec": np.float32, "near": np.int64, "sims": np.float32}
RUN = {"run": np.int64}
MERGE = OFFER | OWN
MEET = OWN | {"want": np.int64, "middle": np.int64}
MEMBER = {"centre": np.int64, "member": np.int64, "least": np.float32, "vec": np.float32}


def _fill(packed: pa.RecordBatch, kinds: dict) -> pa.RecordBatch:
    names = ["bucket", "run_items", "run", *kinds]
    have = {n: packed.column(n) for n in packed.schema.names}
    return pa.RecordBatch.from_pydict({n: have[n] if n in have else pa.nulls(packed.num_rows, pa.binary()) for n in names})


def _rows(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The arrays of node rows; neighbour lists are filled up with -1."""
    out = {"node": batch.column("node").to_numpy().astype(np.int64)}
    for name, kind in (("vec", np.float32), ("near", np.int64), ("sims", np.float32)):
        out[name] = np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1)
    return out


def _node_batch(node, vec, near, sims) -> pa.RecordBatch:
    cut = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(node), cut(vec), cut(near), cut(sims)], ["node", "vec", "near", "sims"])


def _deal_nodes(n_buckets: int, kinds: dict):
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                a = _rows(batch)
                yield _fill(pack(_where(a["node"], n_buckets), np.arange(batch.num_rows), {"run": a["node"]}, a), kinds)

    return work


def _first_nodes(n_buckets: int, k: int):
    """Node rows without neighbours, dealt."""

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                node, unit = batch.column("id").to_numpy(), _units(batch)
                near, sims = np.full((len(node), k), -1), np.full((len(node), k), -2.0, np.float32)
                a = {"node": node, "vec": unit, "near": near, "sims": sims}
                yield _fill(pack(_where(node, n_buckets), np.arange(len(node)), {"run": node}, a), MERGE)

    return work


def _merged(dimensions: int, k: int):
    """Node rows with their best neighbours of before and of the offers."""

    def reduce(a):
        node, vec = a["node"], a["vec"].reshape(-1, dimensions)
        old, old_sims = a["near"].reshape(-1, k), a["sims"].reshape(-1, k)
        order = np.argsort(node)
        node, vec, old, old_sims = node[order], vec[order], old[order], old_sims[order]
        to = np.concatenate([np.repeat(node, k), a["to"]])
        other, sim = np.concatenate([old.ravel(), a["other"]]), np.concatenate([old_sims.ravel(), a["sim"]])
        to, other, sim = to[other >= 0], other[other >= 0], sim[other >= 0]
        order = np.lexsort((other, to))
        to, other, sim = to[order], other[order], sim[order]
        new = np.ones(len(to), bool)
        new[1:] = (to[1:] != to[:-1]) | (other[1:] != other[:-1])
        to, other, sim = to[new], other[new], sim[new]
        order = np.lexsort((other, -sim, to))
        to, other, sim = to[order], other[order], sim[order]
        first, length = K.runs(to)
        rank = np.arange(len(to)) - np.repeat(first, length)
        keep = rank < k
        row = np.searchsorted(node, to[keep])
        near, sims = np.full((len(node), k), -1), np.full((len(node), k), -2.0, np.float32)
        near[row, rank[keep]], sims[row, rank[keep]] = other[keep], sim[keep]
        for at in range(0, len(node), 5_000):
            cut = slice(at, at + 5_000)
            yield _node_batch(node[cut], vec[cut], near[cut], sims[cut])

    return reduce


def _wishes(n_buckets: int):
    """Node rows, and for each neighbour the wish to know its vector."""
    deal = _deal_nodes(n_buckets, MEET)

    def work(batches):
        for batch in batches:
            yield from deal([batch])
            if batch.num_rows:
                a = _rows(batch)
                want, middle = a["near"].ravel(), np.repeat(a["node"], a["near"].shape[1])
                want, middle = want[want >= 0], middle[want >= 0]
                if len(want):
                    yield _fill(pack(_where(want, n_buckets), np.arange(len(want)), {"run": want}, {"want": want, "middle": middle}), MEET)

    return work


def _members(dimensions: int, k: int, n_buckets: int):
    """Bring to each node, as the one in the middle, itself and its neighbours in both directions."""

    def reduce(a):
        node, vec = a["node"], a["vec"].reshape(-1, dimensions)
        near, sims = a["near"].reshape(-1, k), a["sims"].reshape(-1, k)
        order = np.argsort(node)
        node, vec, near, sims = node[order], vec[order], near[order], sims[order]
        least = sims[:, -1]
        if not len(node):
            return
        asked = np.searchsorted(node, a["want"])
        back = np.repeat(np.arange(len(node)), k)[near.ravel() >= 0]
        centre = np.concatenate([a["middle"], near.ravel()[near.ravel() >= 0], node])
        which = np.concatenate([asked, back, np.arange(len(node))])
        for at in range(0, len(which), 100_000):
            c, w = centre[at : at + 100_000], which[at : at + 100_000]
            items = {"centre": c, "member": node[w], "least": least[w], "vec": vec[w]}
            yield pack(_where(c, n_buckets), np.arange(len(c)), {"run": c}, items)

    return reduce


def _meetings(dimensions: int, k: int, n_buckets: int):
    def reduce(a):
        vec = a["vec"].reshape(-1, dimensions)
        order = np.lexsort((a["member"], a["centre"]))
        first, length = K.runs(a["centre"][order])
        for at, n in zip(first.tolist(), length.tolist()):
            own = order[at : at + n]
            member = a["member"][own]
            own = own[np.concatenate(([True], member[1:] != member[:-1]))]
            if len(own) > 4 * k:  # a node that very many have as neighbour: they meet in groups
                own = own[np.argsort(K.mix(a["member"][own].view(U64)))]
            for piece in np.array_split(own, -(-len(own) // (4 * k))):
                yield from _best_offers(a["member"][piece], vec[piece], a["least"][piece], OFFERS, n_buckets)

    return reduce


# Nodes of a bucket, at least: fewer would be many tiny tasks in every round.
BUCKET_NODES = 1_000


def buckets_for(df: DataFrame, count: int) -> int:
    """As many buckets as shuffle partitions, if there are nodes for them."""
    return int(np.clip(count // BUCKET_NODES, 1, bucket_count(df)))


def build_graph(vectors: DataFrame, dimensions: int, count: int, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(node, vec, near, sims): each node's unit vector and its k nearest nodes found, of distinct vectors (id, v)."""
    n = buckets_for(vectors, count)
    bits = int(np.clip(np.ceil(np.log2(max(count / CELL, 1))), 1, 12))
    spread = max(1, int(count / CELL) >> bits)
    cells = vectors.mapInArrow(_celled(n, dimensions, bits, spread), packed_schema(RUN, {"cell": 0, "node": 0, "vec": 0}))
    merge = packed_schema(RUN, MERGE)
    found = exchanged(
        cells, RUN, {"cell": U64, "node": np.int64, "vec": np.float32}, _packed_offers(_cell_neighbours(dimensions, n, k), n), merge, False, n
    )
    own = vectors.mapInArrow(_first_nodes(n, k), merge)
    graph = materialise(exchanged(own.unionByName(found), RUN, MERGE, _merged(dimensions, k), NODES, False, n), "nn-graph")
    for _ in range(rounds):
        wishes = graph.mapInArrow(_wishes(n), packed_schema(RUN, MEET))
        members = exchanged(wishes, RUN, MEET, _members(dimensions, k, n), packed_schema(RUN, MEMBER), False, n)
        offers = exchanged(members, RUN, MEMBER, _packed_offers(_meetings(dimensions, k, n), n), merge, False, n)
        own = graph.mapInArrow(_deal_nodes(n, MERGE), merge)
        graph = materialise(exchanged(own.unionByName(offers), RUN, MERGE, _merged(dimensions, k), NODES, False, n), "nn-graph")
    return graph


STATE = "query long, seen binary, score binary, done binary"
ASK = {"node": np.int64, "vec": np.float32, "near": np.int64, "sims": np.float32, "query": np.int64, "want": np.int64}
TELL = {"query": np.int64, "found": np.int64, "value": np.float32}
BEAMS = TELL | {"own": np.int64, "size": np.int64, "seen": np.int64, "score": np.float32, "done": np.uint8}


def _expanded(n_buckets: int, expand: int):
    """For each query, its best nodes that weren't expanded; and its state, with these marked."""

    def work(batches):
        for batch in batches:
            query, want, states = [], [], []
            for q, seen, score, done in zip(*(batch.column(c).to_pylist() for c in ("query", "seen", "score", "done"))):
                seen, score, done = np.frombuffer(seen, np.int64), np.frombuffer(score, np.float32), np.frombuffer(done, np.uint8).copy()
                # Sorted by score; only what is in sight may be expanded.
                open_ = np.flatnonzero(done[:BEAM] == 0)[:expand]
                query.append(np.full(len(open_), q))
                want.append(seen[open_])
                done[open_] = 1
                states.append((q, seen, score, done))
            if not states:
                continue
            query, want = np.concatenate(query), np.concatenate(want)
            if len(want):
                yield _wide(pack(_where(want, n_buckets), np.arange(len(want)), {"run": want}, {"query": query, "want": want}))
            own, size = np.array([s[0] for s in states]), np.array([len(s[1]) for s in states])
            run = np.repeat(np.arange(len(own)), size)
            arrays = {k: np.concatenate([s[i] for s in states]) for i, k in ((1, "seen"), (2, "score"), (3, "done"))}
            yield _wide(pack(_where(own, n_buckets)[run], run, {"run": own}, arrays))

    return work


WIDE = list(dict.fromkeys([*ASK, *BEAMS]))


def _wide(packed: pa.RecordBatch) -> pa.RecordBatch:
    return _fill(packed, dict.fromkeys(WIDE))


def _near_of(dimensions: int, k: int, n_buckets: int):
    """The neighbours of each node that a query asks for, dealt to where their vectors are; and the node rows again."""

    def reduce(a):
        node, near = a["node"], a["near"].reshape(-1, k)
        order = np.argsort(node)
        if len(node) and len(a["want"]):
            at = order[np.searchsorted(node[order], a["want"])]
            query, want = np.repeat(a["query"], k), near[at].ravel()
            pair = np.unique(np.stack([query[want >= 0], want[want >= 0]]), axis=1)
            if pair.shape[1]:
                yield _wide(pack(_where(pair[1], n_buckets), np.arange(pair.shape[1]), {"run": pair[1]}, {"query": pair[0], "want": pair[1]}))

    return reduce


def _scored(shared, dimensions: int, n_buckets: int):
    """The similarity of each query to the nodes that it asks for, dealt to the queries."""

    def reduce(a):
        ids, units = shared.value
        node, vec = a["node"], a["vec"].reshape(-1, dimensions)
        if not len(node) or not len(a["want"]):
            return
        pair = np.unique(np.stack([a["query"], a["want"]]), axis=1)
        order = np.argsort(node)
        at, q = order[np.searchsorted(node[order], pair[1])], np.searchsorted(ids, pair[0])
        value = np.empty(len(q), np.float32)
        for i in range(0, len(q), 100_000):
            cut = slice(i, i + 100_000)
            value[cut] = np.einsum("ij,ij->i", vec[at[cut]], units[q[cut]])
        yield _wide(pack(_where(pair[0], n_buckets), np.arange(len(q)), {"run": pair[0]}, {"query": pair[0], "found": pair[1], "value": value}))

    return reduce


def _in_sight(a):
    """Each query's nodes, best first; a node keeps whether it was expanded."""
    owner = np.repeat(a["run"], a["run_items"].astype(np.int64))
    # Runs of states come with ``seen``; runs of scores with ``found``: the items of a row are of one sort.
    state = a["is_state"]
    query = np.concatenate([owner[state], a["query"]])
    node = np.concatenate([a["seen"], a["found"]])
    score = np.concatenate([a["score"], a["value"]])
    done = np.concatenate([a["done"], np.zeros(len(a["found"]), np.uint8)])
    order = np.lexsort((1 - done.astype(np.int8), node, query))
    query, node, score, done = query[order], node[order], score[order], done[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (node[1:] != node[:-1])
    query, node, score, done = query[new], node[new], score[new], done[new]
    order = np.lexsort((node, -score, query))
    query, node, score, done = query[order], node[order], score[order], done[order]
    first, length = K.runs(query)
    rows = [(int(query[f]), slice(f, f + n)) for f, n in zip(first.tolist(), length.tolist())]
    for at in range(0, len(rows), 500):
        part = rows[at : at + 500]
        yield pa.RecordBatch.from_pydict(
            {"query": pa.array([q for q, _ in part], pa.int64())}
            | {n: pa.array([x[s].tobytes() for _, s in part], pa.binary()) for n, x in (("seen", node), ("score", score), ("done", done))}
        )


def _exchange_wide(packed: DataFrame, reduce, schema: str, n: int) -> DataFrame:
    """As ``exchanged``, for rows of several sorts; tells items of states from others."""
    kinds = ASK | BEAMS

    def work(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            a = {k: joined(batches, k, t) for k, t in kinds.items()}
            a["run"], a["run_items"] = joined(batches, "run", np.int64), joined(batches, "run_items", np.uint32)
            sizes = [len(x) // 4 for b in batches for x in b.column("run_items").to_pylist()]
            states = [x is not None for b in batches for x in b.column("seen").to_pylist()]
            a["is_state"] = np.repeat(np.repeat(states, sizes), a["run_items"].astype(np.int64))
            yield from reduce(a)

    return packed.repartitionById(n, F.col("bucket")).mapInArrow(work, schema)


def search_graph(graph: DataFrame, queries: DataFrame, starts: np.ndarray, dimensions: int, k: int, expand: int, rounds: int, n: int) -> DataFrame:
    """(query, seen, score, done): what each query (id, v) found, best first. Queries are of a bounded number."""
    spark = graph.sparkSession
    rows = queries.orderBy("id").collect()
    ids = np.array([r[0] for r in rows], np.int64)
    raw = np.array([r[1] for r in rows], float)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast((ids, (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)))
    wide = packed_schema(RUN, dict.fromkeys(WIDE))
    nodes = graph.mapInArrow(_deal_wide(n), wide)

    def first(batches):
        for batch in batches:
            q = batch.column("id").to_numpy()
            query, want = np.repeat(q, len(starts)), np.tile(starts, len(q))
            query, want = np.concatenate([query, q]), np.concatenate([want, batch.column("node").to_numpy()])
            if len(q):
                yield _wide(pack(_where(want, n), np.arange(len(want)), {"run": want}, {"query": query, "want": want}))

    asked = queries.select("id", "node").mapInArrow(first, wide)
    states = None
    for number in range(rounds + 1):
        told = _exchange_wide(nodes.unionByName(asked), _scored(shared, dimensions, n), wide, n)
        if states is not None:
            told = told.unionByName(states.filter("seen is not null"))
        beams = materialise(_exchange_wide(told, _in_sight, STATE, n), "nn-beams")
        if number == rounds:
            return beams
        states = beams.mapInArrow(_expanded(n, expand), wide)
        wanted = states.filter("want is not null")
        asked = _exchange_wide(nodes.unionByName(wanted), _near_of(dimensions, k, n), wide, n)


def _deal_wide(n_buckets: int):
    deal = _deal_nodes(n_buckets, dict.fromkeys(WIDE))
    return lambda batches: deal(batches)


def _best_seen(n: int):
    def work(batches):
        for batch in batches:
            query, node = [], []
            for q, seen in zip(batch.column("query").to_pylist(), batch.column("seen").to_pylist()):
                best = np.frombuffer(seen, np.int64)[:n]
                query.append(np.full(len(best), q))
                node.append(best)
            if query:
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.concatenate(query)), "node": pa.array(np.concatenate(node))})

    return work


def _cosines(batches):
    for batch in batches:
        if batch.num_rows:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("qv", "v"))
            a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
            dot = np.einsum("ij,ij->i", a, b)
            score = dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("node"), pa.array(score)], ["query_id", "node", "score"])


def nearest_neighbours(
    vectors: DataFrame, is_query, n_nearest: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = NEIGHBOURS, rounds: int = ROUNDS, expand: int = EXPAND, search_rounds: int = SEARCH_ROUNDS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` that ``is_query`` (a condition on ``id``), its nearest other rows.

    ``score`` is the cosine in double precision; equal scores go to the
    smaller id. Rows whose id or vector is null, whose vector is zero or has
    a null or non-finite component, or another length than most, take no part.
    Of rows that repeat an id the one with the smallest vector counts. Where there are fewer candidates, all come out. Approximate: see
    the README for the measured recall. Queries go in blocks of about ``QUERY_BLOCK``.
    """
    spark: SparkSession = vectors.sparkSession
    rows = _cosine_ready(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = lengths["d"]
    rows = rows.filter(F.size("v") == dimensions).groupBy("id").agg(F.min("v").alias("v"))
    # Equal vectors are one node, named by the smallest id.
    rows = materialise(rows.withColumn("a", F.xxhash64("v")).withColumn("b", F.xxhash64(F.lit(1), "v")), "nn-vectors")
    nodes = rows.groupBy("a", "b").agg(F.min("id").alias("node"))
    nodes = materialise(nodes, "nn-nodes")
    count = nodes.count()
    distinct = rows.join(nodes.select(F.col("node").alias("id")), "id", "left_semi").select("id", "v")
    distinct = materialise(distinct, "nn-distinct")
    graph = build_graph(distinct, dimensions, count, k, rounds)
    starts = np.array([r[0] for r in nodes.select("node").orderBy(F.xxhash64("node")).limit(ENTRIES).collect()], np.int64)

    queries = rows.filter(is_query)
    # The node of a query that is a copy is found by its vector.
    queries = materialise(queries.join(nodes, ["a", "b"]).select("id", "v", "node"), "nn-queries")
    blocks = -(-queries.count() // QUERY_BLOCK)
    found = None
    for block in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        part = search_graph(graph, part, starts, dimensions, k, expand, search_rounds, buckets_for(rows, count))
        part = part.mapInArrow(_best_seen(4 * n_nearest + 10), "query_id long, node long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pairs = found.join(distinct.withColumnRenamed("id", "node"), "node")
    pairs = pairs.join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("qv")), "query_id")
    exact = pairs.select("query_id", "node", "qv", "v").mapInArrow(_cosines, "query_id long, node long, score double")
    # As many copies of each node as can be among the nearest.
    copies = Window.partitionBy("a", "b").orderBy("id")
    copies = rows.select("a", "b", "id").withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= n_nearest + 1)
    copies = copies.join(nodes, ["a", "b"]).select("node", F.col("id").alias("vec_id"))
    ranked = exact.join(copies, "node").filter("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
