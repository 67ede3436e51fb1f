"""Line dedup, substring dedup and the Jaccard join against brute force."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import pytest

from specloom.llm import jaccard_join
from specloom.llm.components import connected_components
from specloom.llm.jaccard_join import jaccard_classes
from specloom.llm.line_dedup import line_dedup
from specloom.llm.substring_dedup import substring_dedup, substring_digest
from tests.llm.texts import ODD, edited, words

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def corpus():
    """Copies, near copies by the dozen, shared passages, and odd rows."""
    base, passage = words(1, 120), words(2, 40)
    rows = [(i, " ".join(edited(base, i, i / 400))) for i in range(60)]
    rows += [(100 + i, " ".join(words(100 + i, 30) + passage + words(200 + i, 5 + 10 * i))) for i in range(12)]
    rows += [(200 + i, " ".join(passage + words(300 + i, i))) for i in range(14)]
    rows += [(300 + i, " ".join(base).upper()) for i in range(5)]
    rows += [(400, " ".join(words(9, 20_000))), (401, " ".join(words(9, 20_000)[:16_000])), (402, " ".join(["again"] * 400))]
    return rows + [(i, t) for i, t in ODD if i] + [(100, rows[60][1])]


def classes(rows):
    sets = {}
    for i, text in rows:
        w = SPACE.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    where, shared, up = defaultdict(list), defaultdict(int), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for found in where.values():
        for pair in combinations(sorted(found), 2):
            shared[pair] += 1

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), top(i)) for i, _ in rows)


def test_windows_that_share_an_anchor_and_half_a_hash_are_not_repeats():
    import numpy as np

    from specloom.llm import anchors

    window = np.array([7, 7 + (1 << 32), 7], np.uint64)  # the first two differ in the upper half only
    runs = {"doc": [1, 2, 3], "mark": [0, 0, 0], "anchor": [5, 5, 5], "at": [0, 0, 0], "shift": [2, 2, 2]}
    arrays = {k: np.array(runs[k], t) for k, t in anchors.RUNS.items()} | {k: np.zeros(0, t) for k, t in anchors.LOCAL.items()}
    arrays |= {"run_items": np.ones(3, np.uint32), "check": window.astype(anchors.ITEMS["check"])}
    for by_place in (False, True):
        (out,) = anchors._extended(13, by_place, 1)(dict(arrays))
        assert np.frombuffer(out.column("doc")[0].as_py(), np.int64).tolist() == [3]


@pytest.mark.parametrize("rare", [32, 2])
def test_jaccard_classes_equal_brute_force(documents, rare):
    rows = corpus()
    got = jaccard_classes(documents(rows), rare=rare).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == classes(rows)


def test_jaccard_rows_without_id_and_empty_tables(documents):
    got = jaccard_classes(documents([*ODD, (None, None)])).collect()
    assert sorted([tuple(r) for r in got if r.doc_id is None], key=str) == [(None, 0, None), (None, 1, None)]
    assert {tuple(r) for r in got if r.doc_id in (9004, 9005)} == {(9004, 1, 9004), (9005, 1, 9004)}
    assert jaccard_classes(documents([])).collect() == []


def test_key_prefixes_find_every_link_of_frequent_items():
    """Sets of frequent items only: any two linked ones share a key, in the smaller one's short prefix."""
    import random

    import numpy as np

    edges, draw = jaccard_join.bands(75), random.Random(3)
    for _ in range(300):
        pool = np.array(draw.sample(range(1, 10**6), 120), np.uint64)
        df = {int(x): draw.choice([2, 3, 40, 50, 900]) for x in pool}
        size = draw.randrange(4, 80)
        a = np.sort(pool[:size])
        miss = draw.randrange(0, size // 7 + 1)
        b = np.sort(np.concatenate([pool[miss:size], pool[100 : 100 + draw.randrange(0, size // 7 + 1)]]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 75 * (len(a) + len(b) - common) or np.array_equal(a, b):
            continue
        small, large = sorted((a, b), key=len)
        keys = [jaccard_join.set_keys(len(s), s, np.array([df[int(x)] for x in s], np.uint32), 75, edges) for s in (small, large)]
        heads = set(keys[0][0][keys[0][1]].tolist())
        assert heads & set(keys[1][0].tolist()) or (len(a) == len(b) and set(keys[0][0].tolist()) & set(keys[1][0][keys[1][1]].tolist()))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def repeated(items_of, rows, n, by_place):
    """Places of each row's items that lie in a repeated window."""
    first, gone = {}, []
    windows = []
    for r, (i, text) in enumerate(rows):
        key = float("inf") if i is None else i
        items = items_of(text or "")
        windows.append([(tuple(items[k : k + n]), (key, k) if by_place else (key,)) for k in range(len(items) - n + 1)])
        for w, place in windows[-1]:
            first[w] = min(first.get(w, place), place)
    for own in windows:
        gone.append({k + d for k, (w, place) in enumerate(own) if first[w] < place for d in range(n)})
    return gone


def texts_with_repeats():
    passage, more = words(5, 60), words(6, 25)
    rows = [(i, " ".join(words(50 + i, 10) + passage[i : 60 - i] + words(80 + i, 7))) for i in range(20)]
    rows += [(30 + i, " ".join(more)) for i in range(6)] + [(40, " ".join(more[:13])), (41, " ".join(more[:12]))]
    rows += [(50, " ".join(["again"] * 50 + ["other"] * 13)), (51, " ".join(["again"] * 30)), (7, rows[7][1])]
    return rows + ODD + [(None, " ".join(passage))]


def test_substring_dedup_equals_brute_force(documents):
    rows = texts_with_repeats()
    got = substring_dedup(documents(rows)).collect()
    want = []
    for (i, text), gone in zip(rows, repeated(SPACE.findall, rows, 13, False)):
        w = SPACE.findall(text or "")
        kept = None if text is None else " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), kept))
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got], key=str) == sorted(want, key=str)
    digests = {r.kept_sha256 for r in substring_digest(documents([(1, None)])).collect()}
    assert digests == {hashlib.sha256(b"").hexdigest()}
    assert substring_dedup(documents([])).collect() == []


def test_line_dedup_equals_brute_force(documents):
    head, notice = [f"line {i}" for i in range(6)], ["a", "", "b", "c"]
    rows = [(i, "\n".join([f"own {i}", *head[i % 3 :], f"end {i}"])) for i in range(8)]
    rows += [(20, "\n".join(notice * 4)), (21, "\n".join(["x", *notice])), (22, "\n".join(["r"] * 9)), (22, "\n".join(["r"] * 9))]
    rows += [(24, "a\nb"), (25, "\n\n"), *ODD, (None, "\n".join(head))]
    got = line_dedup(documents(rows)).collect()
    want = []
    for (i, text), gone in zip(rows, repeated(lambda t: [x for x in t.split("\n") if x], rows, 3, True)):
        lines = (text or "").split("\n")
        filled = [k for k, x in enumerate(lines) if x]
        kept = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in {filled[g] for g in gone})
        want.append((i, len(filled), len(gone), kept))
    assert sorted([(r.doc_id, r.n_lines, r.n_removed, r.text) for r in got], key=str) == sorted(want, key=str)
    assert {"lang", "text.n", "score", "rest"} <= set(line_dedup(documents([])).columns)


@pytest.mark.parametrize("block_sets", [50, 4096])
def test_near_copies_around_the_threshold_equal_brute_force(documents, monkeypatch, block_sets):
    """A large group of which many pairs lie just below 75 %, and some just above, in one block or a grid of them."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block_sets)
    monkeypatch.setattr(jaccard_join.linked_in_clusters, "__defaults__", (block_sets,))
    base = words(41, 160)
    rows = []
    for i in range(300):
        text = list(base)
        for k in range(3 + i % 3):  # each changed word breaks five shingles
            text[(i * 7 + k * 31) % 160] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [rows[5]] * 3
    got = sorted(map(tuple, jaccard_classes(documents(rows)).collect()))
    assert got == classes(rows)
    assert len({r[2] for r in got}) > 50


def test_a_forest_joins_what_pairs_join():
    import numpy as np

    pairs = np.array([[5, 9, 3, 8, 20, 21], [9, 3, 4, 8, 21, 20]])
    assert sorted(zip(*jaccard_join._forest(pairs).tolist())) == [(4, 3), (5, 3), (9, 3), (21, 20)]


def test_the_filter_passes_every_candidate(spark):
    import numpy as np

    ids = spark.range(0, 5000, 7).toDF("doc_id")
    table = jaccard_join.candidate_filter(ids, ids.count())
    all_ids = np.arange(5000)
    keep = np.ones(5000, bool)
    for place in jaccard_join._filter_places(all_ids, len(table) << 6):
        keep &= (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
    assert keep[::7].all() and keep.sum() < 1000
