"""Hard negatives and vector codes against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from opsmart.llm import hard_negatives as hn
from opsmart.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, score string, q string, uid string, x string, code string, error string"


@pytest.fixture(scope="module")
def vectors(spark):
    """A table of vectors, with further columns whose names the operators use."""
    return lambda rows: spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def whole(v, scale):
    return [math.floor(float(np.float32(c)) * scale) for c in v]


def mined(rows, every=50):
    rows = {(i, int(math.fmod(label + 1, 10)) if i % 7 == 0 else label, tuple(whole(v, 256))) for i, v, label in rows if None not in (i, label) and usable(v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))  # noqa: E731  shorter ones end in zeros
    out = []
    for a in (r for r in rows if r[0] % every == 0):
        near = sorted((-dot(a[2], r[2]), r[0]) for r in rows if r[1] == a[1] and r != a)[:5]
        others = sorted((-dot(a[2], r[2]), r[0]) for r in rows if r[1] != a[1])
        for p, positive in near:
            fit = [(s, i) for s, i in others if -50 * p <= -100 * s <= -95 * p][:3]
            out += [(a[0], positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fit, 1)]
    return Counter(out)


def some_vectors(seed, n, width=6, labels=4, grid=None, copies=0):
    rnd = np.random.default_rng(seed)
    points = rnd.normal(size=(n, width)) * rnd.uniform(0.2, 1, size=(n, 1))
    if grid:
        points = np.round(points * grid) / grid  # many ties
    if copies:
        points[rnd.integers(0, n, copies)] = points[0]
    return [(i, [float(c) for c in p], int(rnd.integers(0, labels))) for i, p in enumerate(points)]


CASES = {
    "scattered": some_vectors(1, 400),
    "ties": some_vectors(2, 400, width=3, grid=2),
    "copies": some_vectors(3, 300, copies=120),
    "many labels": [(i, v, i % 130) for i, v, _ in some_vectors(4, 400)],
    "negative ids and labels": [(i - 200, v, k - 2) for i, v, k in some_vectors(5, 400)],
    "one label": [(i, v, 3) for i, v, _ in some_vectors(6, 120)],
    "zero vectors": [(i, [0.0] * 4 if i % 3 else v, k) for i, v, k in some_vectors(7, 200, width=4)],
    "lengths differ": [(i, v[: 1 + i % 6], k) for i, v, k in some_vectors(8, 200)],
    "clusters": [(i, [c + 5 * (i % 9 == j) for j, c in enumerate(v)], k) for i, v, k in some_vectors(9, 500, width=9)],
}


@pytest.mark.parametrize("case", CASES)
def test_hard_negatives(vectors, case):
    rows = CASES[case]
    want = mined(rows)
    assert want or case in ("one label",)
    for sizes in [{"pivots": 7, "block_rows": 20, "anchors_at_once": 3}] + [{}] * (case == "scattered"):
        got = Counter(tuple(r) for r in hn.hard_negatives(vectors(rows), **sizes).collect())
        assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_tree_search_is_exact_and_skips(seed):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(30, 16)) * 300
    points = np.floor(middle[rnd.integers(0, 30, 3000)] + rnd.normal(size=(3000, 16)) * (5 + 20 * seed))
    ids, label = rnd.permutation(3000), rnd.integers(0, 5, 3000)
    tree = hn.build(points, ids, ids, label)
    assert sorted(tree.uid.tolist()) == sorted(ids.tolist()) and len(tree.start) > 20
    for k in range(len(tree.start)):  # nesting
        a, n = int(tree.child[k]), int(tree.children[k])
        if n:
            assert [*tree.start[a : a + n], tree.end[k]] == [tree.start[k], *tree.end[a : a + n]]
    anchors, own = points[:40], label[:40]
    scores = anchors @ tree.points.T
    low, high = np.full(40, -np.inf), np.quantile(scores, 0.9, axis=1).round()
    touched = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                touched.append(key.stop - key.start)
            return super().__getitem__(key)

    tree.label = tree.label.view(Counting)
    for same in (True, False):
        touched.clear()
        got = hn.search(tree, anchors, ids[:40], own, hn.Queries(np.arange(40), low, high, low), 5, same)
        for a in range(40):
            fits = ((np.asarray(tree.label) == own[a]) == same) & (tree.uid != ids[a]) & (scores[a] <= high[a])
            want = sorted(zip(-scores[a][fits], tree.vec_id[fits], strict=True))[:5]
            assert [(-s, i) for s, i in zip(got.score[a], got.vec_id[a], strict=True)] == want
    if seed == 0:  # well separated: one anchor looks at few of the points
        touched.clear()
        hn.search(tree, anchors[:1], ids[:1], own[:1], hn.Queries(np.zeros(1, int), low[:1], low[:1] * 0 + np.inf, low[:1]), 5, False)
        assert sum(touched) < 1000


def test_hard_negatives_on_odd_rows(vectors, spark):
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(11, 150, width=4)
    odd = [(None, [1.0] * 4, 1), (50, None, 1), (100, [1.0, None, 1.0, 1.0], 1), (150, [nan] * 4, 2), (200, [inf, 0.0, 0.0, 0.0], 2),
           (250, [1.0] * 4, None), (300, [], 1), rows[3], rows[0], rows[0], (50, [0.5] * 4, 2)]
    got = Counter(tuple(r) for r in hn.hard_negatives(vectors(rows + odd)).collect())
    assert got == mined(rows + odd)
    assert hn.hard_negatives(vectors([])).collect() == []
    assert hn.hard_negatives(vectors([(1, [1.0], 2)])).collect() == []
    assert hn.hard_negatives(vectors([(50, [1.0], 2)])).collect() == []
    with pytest.raises(Exception, match="too large"):
        hn.hard_negatives(vectors([(50, [5000.0], 2)])).collect()


# ---- codes -------------------------------------------------------------------


def coded(rows, entries=256):
    kept = [(i, whole(v, 1024), k) for i, v, k in rows if usable(v)]
    width = max(4, -(-max(len(v) for _, v, _ in kept) // 4) * 4)
    kept = [(i, v + [0] * (width - len(v)), k) for i, v, k in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = width // 4
    cut = lambda v, p: tuple(v[p * size : (p + 1) * size])
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(4)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            home = defaultdict(list)
            for _, v, _ in kept:
                home[best(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, parts in home.items():
                books[p][k] = tuple(sum(c) // len(parts) for c in zip(*parts, strict=True))
    found = [[best(cut(v, p), books[p]) for p in range(4)] for _, v, _ in kept]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    per_label = Counter()
    for (_, _, k), e in zip(kept, errors, strict=True):
        per_label[k] += e
    return Counter(
        (i, "".join(f"{k:02x}" for _, k in f), e, per_label[label], digest) for (i, _, label), f, e in zip(kept, found, errors, strict=True)
    )


CODES = {
    "scattered": some_vectors(21, 330, width=8),
    "ties": some_vectors(22, 330, width=8, grid=1),
    "copies": some_vectors(23, 330, width=8, copies=200),
    "few rows": some_vectors(24, 5, width=4),
    "lengths differ": [(i, v[: i % 7], k) for i, v, k in some_vectors(25, 60, width=6)],
    "no components": [(i, [], 1) for i in range(3)],
}


@pytest.mark.parametrize("case", CODES)
def test_vector_codes(vectors, case):
    got = Counter(tuple(r) for r in vc.vector_codes(vectors(CODES[case]).repartition(3)).collect())
    assert got == coded(CODES[case])


def test_trie_is_brute_force():
    rnd = np.random.default_rng(31)
    for top, width in ((2, 5), (5, 3), (400, 16), (1, 1)):
        parts = np.unique(rnd.integers(-top, top, (700, width)), axis=0)
        entries = rnd.integers(-top, top, (50, width))
        distance = ((parts[:, None] - entries) ** 2).sum(axis=2)
        for leaves in (1, 7, 2048):
            code, error = vc.nearest(parts, entries, leaves)
            assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()


def test_vector_codes_on_odd_rows(vectors):
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(26, 280, width=4)
    odd = [(None, [1.0] * 4, 1), (None, [2.0] * 4, None), (3, None, 1), (4, [1.0, None, 1.0, 1.0], 1), (5, [nan] * 4, 2), (6, [-inf, 0.0, 0.0, 0.0], 2),
           (7, [0.25] * 4, None), rows[3], rows[0], rows[0]]
    got = Counter(tuple(r) for r in vc.vector_codes(vectors(rows + odd)).collect())
    assert got == coded(rows + odd)
    assert vc.vector_codes(vectors([])).collect() == []
    assert vc.vector_codes(vectors([(1, None, 2)])).collect() == []
    with pytest.raises(Exception, match="too large"):
        vc.vector_codes(vectors([(50, [20000.0], 2)])).collect()


def test_decode(vectors, spark):
    rows = some_vectors(27, 300, width=8)
    usable_rows = vc._usable(vectors(rows))
    books = vc.codebooks(usable_rows, 8)
    back = {r["vec_id"]: (r["vector"], r["error"]) for r in vc.decode(vc.encode(usable_rows, books), books).collect()}
    for i, v, _ in rows:
        assert sum((a - b) ** 2 for a, b in zip(whole(v, 1024), back[i][0], strict=True)) == back[i][1]
