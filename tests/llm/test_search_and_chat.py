"""Shared search, chat formatting and whitening against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from specloom.llm import chat_format as C
from specloom.llm.shared_search import accumulated, mined, shared_search
from specloom.llm.whitening import _vectors, eigenvectors, whiten
from tests.llm.texts import ODD, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def ranks(documents, items, best=10):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in documents]
    docs = [d for d in docs if d[1]]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in docs:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in TERM.findall((text or "").translate(LOWER))
                if c[t]
            )
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, f[3], -f[0]) for k, f in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=str)


def test_shared_search_equals_brute_force(spark, documents):
    rows = [(i, " ".join(words(i, 5 + 7 * i % 60, 80))) for i in range(150)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [rows[5], rows[5], (7, rows[8][1])]
    rows += [(600, " ".join(words(9, 40_000, 300))), (601, "Straße ÉTÉ été 12a"), *ODD]
    items = [(i, " ".join(words(900 + i % 9, 12 + i % 5, 80) + words(77, 6, 80))) for i in range(40)]
    items += [(50, items[3][1]), (50, items[3][1]), (51, "STRASSE straße ÉtÉ W1 w1,w1"), (52, None), (53, "?!"), (None, "w2 w3"), (54, "unheard")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, `text.n` int")
    for size in (20_000, 60):  # one block, and many
        got = shared_search(documents(rows), table, block_terms=size)
        assert sorted(map(tuple, got.collect()), key=str) == ranks(rows, items)
    assert shared_search(documents([]), table).count() == 0
    assert shared_search(documents(rows), table.limit(0)).count() == 0


def test_queries_share_sums():
    draw = np.random.default_rng(3)
    common = draw.integers(0, 10**12, 12)
    queries = [np.concatenate((common, draw.integers(0, 10**12, 5), common[:2])) for _ in range(20)] + [np.zeros(0, np.int64)]
    plan = mined(queries)
    values = draw.integers(0, 1000, (len(plan.terms), 7))
    got = accumulated(plan, values)
    for q, query in enumerate(queries):
        assert (got[q] == values[np.searchsorted(plan.terms, query)].sum(axis=0)).all()
    additions = len(plan.nodes) + sum(max(len(t) - 1, 0) for t in plan.tops)
    assert additions < 0.5 * sum(max(len(q) - 1, 0) for q in queries)


CHATS = [
    (1, 0, "system", "be <|brief|>"),
    (1, 1, "user", C.PROBE),
    (1, 2, "assistant", "<\\|x <\\\\| <| \\ 😀é\n\n<|image|>"),
    (2, 0, "user", None),
    (2, 1, None, ""),
    (3, 1, "assistant", "b"),
    (3, 1, "assistant", "a"),
    (3, 1, "assistant", "a"),
    (3, None, "ro\nle\\n<|im_start|>\\", "x"),
    (None, 0, "assistant", "no id"),
    (4, 0, "user", "y" * 200_000),
    (4, 1, "assistant", "z<|" * 100_000),
]


def test_chat_digest_equals_brute_force(spark):
    rows = spark.createDataFrame([(*r, 1) for r in CHATS], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in C.format_digest(C.with_probe(rows)).collect()}
    given = [*CHATS, (-1, 0, "user", C.PROBE), (-1, 1, "assistant", C.PROBE)]
    assert set(got) == {r[0] for r in given}
    for conv, found in got.items():
        turns = sorted((t is not None, t or 0, role or "", text or "") for c, t, role, text in given if c == conv)
        turns = [t[2:] for t in turns]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert found.n_turns == len(turns)
        assert found.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (found.loss_chars, found.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert C.format_digest(rows.limit(0)).count() == 0


def test_parts_become_placeholders_and_come_back(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, ms=None, p=None: (kind, text, ref, w, h, ms, p)
    user = [part("text", "see <|image|> "), part("image", ref="a.png", w=57, h=28), part("audio", ref="b.wav", ms=81), None, part("text", "and"), part("document", ref="c.pdf", p=3)]
    rows = [(1, 0, "user", user), (1, 1, "assistant", [part("image", ref="d.png"), part("verse", "x"), part(None)]), (1, 2, "user", None)]
    out = C.formatted(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{C.PART}>"))
    row = out.withColumn("back", C.parts_read_back(out.formatted)).withColumn("loss", C.loss_text(out.formatted, out.loss_mask)).first()
    assert row.formatted == (
        "<|im_start|>user\nsee <\\|image|> <|image|><|audio|>and<|document|><|im_end|>\n"
        "<|im_start|>assistant\n<|image|>x<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    )
    assert [tuple(a) for a in row.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 3), (0, "document", "c.pdf", 768), (1, "image", "d.png", 0)]
    assert row.n_attachment_tokens == 774 and row.loss == "<|image|>x"
    kinds = [[tuple(p) for p in turn] for turn in row.back]
    assert kinds == [
        [("text", "see <|image|> "), ("image", None), ("audio", None), ("text", "and"), ("document", None)],
        [("image", None), ("text", "x")],
        [],
    ]


def test_chat_plan_is_native(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    plan = C.format_digest(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


def rotation(d, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (np.longdouble(1.5) * np.eye(d) - np.longdouble(0.5) * (q.T @ q))
    return q


@pytest.mark.parametrize(
    "values",
    [
        np.arange(40, 0, -1.0) ** 2,
        [1e3, 100 + 1e-6, 100, 100 - 1e-6, 5, 1 + 3e-9, 1 + 1e-9, 1],
        [7.0, 7.0, 7.0, 3.0, 3.0, 0.0],
        10.0 ** -np.arange(0, 12, 0.5),
        [2.0] * 9,
        [4.0],
        [0.0, 0.0],
    ],
)
def test_eigenvectors_are_exact_to_double_precision(values):
    values = np.array(values, np.longdouble)
    q = rotation(len(values), 1)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = eigenvectors(a)
    assert np.abs(got - values).max() <= 4e-16 * values.max()
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(len(values))).max() < 4e-16
    assert np.abs(a @ wide - wide * got).max() <= 4e-16 * max(values.max(), 1e-300)
    for value in set(values.tolist()):  # the space of equal eigenvalues is right; so is a single vector, as far as its gap tells
        same = values == value
        gap = np.abs(values[~same] - value).min(initial=np.inf) / max(values.max(), 1e-300)
        ours = wide[:, same]
        assert np.abs(ours @ ours.T - q[:, same] @ q[:, same].T).max() < 1e-15 + 1e-17 / gap


def test_whitening_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    vectors = (draw.normal(size=(400, 6)) * [1, 2, 3, 4, 5, 6] @ draw.normal(size=(6, 12)) / 50 + draw.normal(size=(400, 12)) / 100).tolist()
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(3, vectors[3], 1)] * 150 + [(None, vectors[4], 1)]
    odd = [(900, None, 1), (901, [*vectors[0][:11], None], 1), (902, [*vectors[0][:11], math.nan], 1), (903, [*vectors[0][:11], math.inf], 1), (904, [], 1)]
    short = [(1000 + i, v, 1) for i, v in enumerate(draw.normal(size=(20, 2)).tolist())]
    alone = [(2000, [1.0, 2.0, 3.0], 1)]
    schema = "vec_id long, embedding array<double>, component int"
    got = whiten(spark.createDataFrame(rows + odd + short + alone, schema).repartition(5)).collect()
    assert len(got) == 8 * len(rows) + 2 * len(short)
    for part, k in ((rows, 8), (short, 2)):
        x = np.floor(1024 * np.array([v for _, v, _ in part])) + 100000
        n = len(x)
        values, vectors_of = np.linalg.eigh(np.cov(x.T, bias=True))
        values, vectors_of = values[::-1][:k], vectors_of[:, ::-1][:, :k]
        z = (x - x.mean(axis=0)) @ vectors_of / np.sqrt(values)
        want = {part[i][0]: i for i in range(n)}
        seen = np.zeros((n, k))
        for r in got:
            if r.vec_id in want and r.n == n:
                i = want[r.vec_id]
                seen[i, r.component - 1] = r.whitened
                total = sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], x.sum(axis=0)))
                assert r.deviation == total and r.identity_error < 1e-9
                assert abs(r.explained - values[r.component - 1] / np.trace(np.cov(x.T, bias=True))) < 1e-12
        signs = np.sign((seen * z).sum(axis=0))
        for i, (vec, _, _) in enumerate(part):
            assert np.abs(seen[want[vec]] * signs - z[i]).max() < 1e-8
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame(odd + alone, schema)).count() == 0


def test_huge_entries_do_not_crash(spark):
    rows = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)]) for i in range(6)], "vec_id long, embedding array<double>")
    assert all(r.deviation is None for r in whiten(rows).collect())


def test_vectors_of_slices():
    import pyarrow as pa

    column = pa.array([[1.0], None, [2.0, 3.0], [math.nan], [4.0]]).slice(1)
    found = {x.shape[1]: (rows.tolist(), x.tolist()) for rows, x in _vectors(column)}
    assert found == {1: ([3], [[104096]]), 2: ([1], [[102048, 103072]])}
