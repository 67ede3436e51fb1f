"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins, again and again, the two neighbouring pieces whose
joint piece has the best score (the leftmost of equal ones). Here a hash of
(seed, variant, word, place, joint piece) takes each candidate merge off the
agenda with probability ``dropout``, so the same text gets varied
segmentations, which are the same on every run and every executor, and all of
which decode to the text. Without dropout the result is the model's own.

No piece has a word mark but at its front, so no merge crosses the front of a
word or a character that the model lacks; words are segmented on their own,
each distinct (word, variant) of a task slice once. Which of the variants a
word gets depends on the seed, its document and its place.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.llm import textkernel as K
from specloom.llm.exchange import U64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
VARIANTS = 8
# Words up to this many characters are segmented all at once, one merge of each word in a round.
LONG_WORD = 48
MARK = 0x2581
NONE = np.int32(2**31 - 1)


class Pieces:
    """A merge-type vocabulary as arrays: characters, merges, ranks, bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = vocabulary.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        normal: dict[str, int] = {}
        self.texts: list[bytes] = []
        for i in range(n):
            piece = vocabulary.id_to_piece(i)
            if vocabulary.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i):
                self.texts.append(b"")
            else:
                normal[piece] = i
                self.texts.append(piece.replace(chr(MARK), " ").encode())
                if chr(MARK) in piece.lstrip(chr(MARK)):
                    raise ValueError(f"a word mark inside piece {piece!r}: words can't be segmented on their own")
        self.chars = np.full(0x110000, -1, np.int32)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        scores = np.array([vocabulary.get_score(i) for i in range(n)])
        self.rank = np.empty(n, np.int32)
        self.rank[np.argsort(-scores, kind="stable")] = np.arange(n)
        merges = {
            (normal[p[:k]], normal[p[k:]]): i
            for p, i in normal.items()
            for k in range(1, len(p))
            if p[:k] in normal and p[k:] in normal
        }
        self.merges = merges
        # The merges as an open hash table.
        size = 1 << (max(len(merges), 1) * 4 - 1).bit_length()
        self.slots = U64(size - 1)
        left, right = np.array(list(merges) or [(0, 0)]).T
        keys = (left.astype(U64) << U64(32)) | right.astype(U64)
        self.keys, self.joint = np.full(size, 2**64 - 1, U64), np.full(size, -1, np.int32)
        self.probes = 0
        open_ = np.arange(len(merges))
        values, slot = np.array(list(merges.values()) or [0], np.int32), K.mix(keys) & self.slots
        while len(open_):
            s = (slot[open_] + U64(self.probes)) & self.slots
            free = np.flatnonzero(self.joint[s] < 0)
            s_free, index = np.unique(s[free], return_index=True)
            taken = open_[free[index]]
            self.keys[s_free], self.joint[s_free] = keys[taken], values[taken]
            open_ = np.setdiff1d(open_, taken)
            self.probes += 1

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each two neighbours make, or -1."""
        out = np.full(len(left), -1, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[open_].astype(U64) << U64(32)) | right[open_].astype(U64)
        slot = K.mix(keys) & self.slots
        for probe in range(self.probes):
            s = (slot + U64(probe)) & self.slots
            at = self.keys[s]
            hit = at == keys
            out[open_[hit]] = self.joint[s[hit]]
            on = ~hit & (at != U64(2**64 - 1))
            open_, keys, slot = open_[on], keys[on], slot[on]
            if not len(open_):
                break
        return out


@lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    return Pieces(model)


def _kept(word: np.ndarray, left: np.ndarray, right: np.ndarray, joint: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the keyed hash leaves a candidate merge on the agenda."""
    place = (left.astype(U64) << U64(32)) | right.astype(U64)
    return K.mix(word + K.mix(place + K.mix(joint.astype(U64) + U64(11)))) >= limit


def segment_words(pieces: Pieces, symbols: np.ndarray, first: np.ndarray, keys: np.ndarray, limit: np.uint64):
    """The pieces of each word and how many it has.

    ``symbols``: character pieces (-1: not in the model) of all words, which
    begin at ``first``; ``keys``: a 64-bit key of each word and its variant.
    """
    lengths = np.diff(np.append(first, len(symbols)))
    done_word, done_symbol, done_place = [], [], []
    for w in np.flatnonzero(lengths > LONG_WORD).tolist():
        own = symbols[first[w] : first[w] + lengths[w]]
        found, places = _segment_long(pieces, own, keys[w], limit)
        done_word.append(np.full(len(found), w))
        done_symbol.append(found)
        done_place.append(places)
    word = np.repeat(np.arange(len(first)), lengths)
    place = (np.arange(len(symbols)) - np.repeat(first, lengths)).astype(np.int32)
    short = (lengths <= LONG_WORD)[word]
    word, place, symbols = word[short], place[short], symbols[short].copy()

    def candidates(i):
        out = np.full(len(i), -1, np.int32)
        inner = i + 1 < len(word)
        i = i[inner]
        inner[inner] = word[i] == word[i + 1]
        i = i[word[i] == word[i + 1]]
        joint = pieces.joined(symbols[i], symbols[i + 1])
        some = np.flatnonzero(joint >= 0)
        at = i[some]
        joint[some[~_kept(keys[word[at]], place[at], place[at + 1], joint[some], limit)]] = -1
        out[inner] = joint
        return out

    joint = candidates(np.arange(len(symbols)))
    rank = np.where(joint >= 0, pieces.rank[joint], NONE)
    while len(word):
        begin, length = K.runs(word)
        best = np.repeat(np.minimum.reduceat(rank, begin), length)
        over = best == NONE
        if over.any():
            done_word.append(word[over])
            done_symbol.append(symbols[over])
            done_place.append(place[over])
            on = ~over
            word, place, symbols, joint, rank, best = (x[on] for x in (word, place, symbols, joint, rank, best))
            if not len(word):
                break
        at = np.flatnonzero(rank == best)
        at = at[np.concatenate(([True], word[at][1:] != word[at][:-1]))]
        symbols[at] = joint[at]
        stay = np.ones(len(word), bool)
        stay[at + 1] = False
        word, place, symbols, joint, rank = (x[stay] for x in (word, place, symbols, joint, rank))
        at = at - np.arange(len(at))
        again = np.concatenate((at, at[(at > 0)] - 1))
        joint[again] = candidates(again)
        rank[again] = np.where(joint[again] >= 0, pieces.rank[joint[again]], NONE)
    if not done_word:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(first), np.int64)
    word = np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return (
        np.concatenate(done_symbol)[order],
        np.concatenate(done_place)[order],
        np.bincount(word, minlength=len(first)),
    )


def _segment_long(pieces: Pieces, symbols: np.ndarray, key: np.uint64, limit: np.uint64):
    """One long word by an agenda in a heap."""
    ids, n = symbols.tolist(), len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []
    alive = [True] * n
    word = np.array([key], U64)

    def offer(left: int, right: int) -> None:
        joint = pieces.merges.get((ids[left], ids[right]))
        if joint is not None and _kept(word, np.array([left]), np.array([right]), np.array([joint]), limit)[0]:
            heapq.heappush(agenda, (int(pieces.rank[joint]), left, right, joint, ids[left] << 32 | ids[right]))

    for i in range(n - 1):
        offer(i, i + 1)
    while agenda:
        _, left, right, joint, made_of = heapq.heappop(agenda)
        if not (alive[left] and alive[right] and after[left] == right and ids[left] << 32 | ids[right] == made_of):
            continue
        ids[left], alive[right], after[left] = joint, False, after[right]
        if after[left] < n:
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    left = [i for i in range(n) if alive[i]]
    return np.array([ids[i] for i in left], np.int32), np.array(left, np.int32)


def _utf8(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of characters (four columns) and how many count; escaped bytes stand for themselves."""
    raw = (code >= 0xDC80) & (code <= 0xDCFF)
    size = np.select([code < 0x80, raw, code < 0x800, code < 0x10000], [1, 1, 2, 3], 4)
    out = np.zeros((len(code), 4), np.uint32)
    for n, front in ((2, 0xC0), (3, 0xE0), (4, 0xF0)):
        rows = size == n
        for k in range(n):
            part = code[rows] >> (6 * (n - 1 - k))
            out[rows, k] = front | part if k == 0 else 0x80 | (part & 0x3F)
    out[size == 1, 0] = code[size == 1] & 0xFF
    return out, size


def encode_texts(pieces: Pieces, texts: list[bytes], doc_keys: np.ndarray, seed: int, dropout: float, variants: int):
    """The piece ids of all texts, and how many each text has."""
    decoded = [t.decode("utf-8", "surrogateescape") for t in texts]
    sizes = np.array([len(t) + 1 if t else 0 for t in decoded])
    joined = "".join(" " + t for t in decoded if t)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    space = code == 0x20
    symbols = pieces.chars[np.where(space, MARK, code)]
    symbols[code == MARK] = -1  # else it would decode to a space
    text_first = np.cumsum(sizes) - sizes
    head = space.copy()
    head[1:] &= ~space[:-1]
    alone = symbols < 0
    head |= alone
    head[1:] |= alone[:-1]
    head[text_first[sizes > 0]] = True
    first = np.flatnonzero(head)
    lengths = np.diff(np.append(first, len(code)))
    text = np.searchsorted(text_first + sizes, first, "right")
    # Each word's key: its characters and its variant.
    weights = K.powers(int(lengths.max()))
    place = np.arange(len(code)) - np.repeat(first, lengths)
    own = np.add.reduceat(K.mix(code.astype(U64) + U64(1)) * weights[place], first)
    within = (first - text_first[text]).astype(U64)
    variant = K.mix(doc_keys[text] + K.mix(within + U64(seed))) % U64(variants)
    keys = K.mix(own + K.mix(lengths.astype(U64)) + K.mix(variant + U64(seed) * U64(1_000_003)))
    distinct, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    d_first, d_length = first[at], lengths[at]
    begin = np.cumsum(d_length) - d_length
    where = np.arange(int(d_length.sum())) + np.repeat(d_first - begin, d_length)
    limit = U64(min(int(dropout * 2**64), 2**64 - 1))
    found, places, counts = segment_words(pieces, symbols[where], begin, distinct, limit)
    # Characters that the model lacks become their bytes.
    lacking = np.flatnonzero(found < 0)
    if len(lacking):
        word = np.repeat(np.arange(len(counts)), counts)
        utf8, size = _utf8(code[d_first[word[lacking]] + places[lacking]])
        repeat = np.ones(len(found), np.int64)
        repeat[lacking] = size
        start = np.cumsum(repeat) - repeat
        found = np.repeat(found, repeat)
        for k in range(4):
            has = size > k
            found[start[lacking[has]] + k] = pieces.byte_ids[utf8[has, k]]
        counts = np.add.reduceat(repeat, np.cumsum(counts) - counts)
    piece_first = np.cumsum(counts) - counts
    n = counts[inverse]
    out_first = np.cumsum(n) - n
    ids = found[np.arange(int(n.sum())) + np.repeat(piece_first[inverse] - out_first, n)]
    return ids, np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64)


def decode_ids(pieces: Pieces, ids: np.ndarray) -> bytes:
    """The text of one document's ids."""
    return b"".join(map(pieces.texts.__getitem__, ids.tolist()))[1:]


def _list_array(ids: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=pa.array(null))


def _model(spark: SparkSession, path: str):
    """The model's bytes (a megabyte or so, whatever the data) for all executors."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(
    documents: DataFrame, model: str = MODEL, seed: int = 0, dropout: float = DROPOUT, variants: int = VARIANTS, check: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row of ``documents``; with ``check`` also whether decoding gives the text back.

    Null text has null ids, no tokens and counts as given back; empty text has
    no ids. Ids depend on the text, the doc_id (null counts as one id) and
    the seed only: repeated rows get the same. Other columns are not looked at.
    """
    shared = _model(documents.sparkSession, model)

    def work(batches):
        pieces = pieces_of(shared.value)
        for part in K.text_slices(batches, limit=3_000_000):
            raw = part.column("text").cast(pa.binary())
            texts = [x or b"" for x in raw.to_pylist()]
            doc_keys = K.mix(part.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
            ids, counts = encode_texts(pieces, texts, doc_keys, seed, dropout, variants)
            columns = {
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array(counts),
                "ids": _list_array(ids, counts, raw.is_null().to_numpy(zero_copy_only=False)),
            }
            if check:
                cut = np.concatenate(([0], np.cumsum(counts)))
                same = [decode_ids(pieces, ids[a:b]) == t for t, a, b in zip(texts, cut[:-1], cut[1:])]
                columns["round_trip"] = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_pydict(columns)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(work, "doc_id long, n_tokens long, ids array<int>" + ", round_trip boolean" * check)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null text. Any segmentation decodes to its text."""
    shared = _model(encoded.sparkSession, model)

    def work(batches):
        pieces = pieces_of(shared.value)
        for batch in batches:
            texts = [None if x is None else decode_ids(pieces, np.asarray(x, np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string(), safe=False)}
            )

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")
