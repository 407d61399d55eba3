"""The trained operators: their parts against brute force, and held-out accuracy."""

import math
import os
import random
import zlib

import numpy as np
import pytest

from opsmart.llm import quality_cnn, toxicity
from opsmart.llm.common import labelled_sample

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def agreement(spark, result, label):
    known = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = result.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    return np.mean([a == b for a, b in held])


@needs_tables
def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    result = quality_cnn.classify(docs, labels)
    assert agreement(spark, result, "quality") > 0.9
    good = {r["doc_id"] for r in result.where("predicted = 1").collect()}
    kept = quality_cnn.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good


@needs_tables
def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    assert agreement(spark, toxicity.classify(docs, labels), "toxic") > 0.85


def test_sample_is_bounded_and_leaves_held_out_rows_out(spark, frame, labels):
    docs = frame([(i, f"text {i}") for i in range(60)] + [(60, "x" * 30_000), (61, None)])
    rows = [(i, i % 2, 0, "x") for i in range(62)] + [(3, 0, 0, "x"), (None, 1, 1, "x"), (9, None, None, "x")]
    found = labelled_sample(docs, labels(rows), "quality", 5)
    assert len(found) == 10 and found == labelled_sample(docs, labels(rows), "quality", 5)
    everything = {i: (t, y) for i, t, y in labelled_sample(docs, labels(rows), "quality", 1000)}
    want = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1} - {3}  # 3 has contradictory labels
    assert set(everything) == want and all(everything[i] == (f"text {i}", i % 2) for i in want)


def test_chunks_cover_everything():
    step = quality_cnn.CHUNK - quality_cnn.OVERLAP
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(i % 251 for i in range(n))
        rows = quality_cnn.chunks(data)
        seen = {}
        for k, row in enumerate(rows):
            seen.update({k * step + j: int(b) for j, b in enumerate(row) if b != 256})
        assert [seen[i] for i in range(n)] == list(data) and len(seen) == n


def test_repetition_channel():
    rnd = random.Random(1)
    data = ("".join(rnd.choice("ab ") for _ in range(200)) + "word word word word" + "x" * 30).encode()
    got = quality_cnn.repeated(quality_cnn.chunks(data))[0][: len(data)]
    want = [any(i - 7 - d >= 0 and data[i - 7 : i + 1] == data[i - 7 - d : i + 1 - d] for d in range(2, 33)) for i in range(len(data))]
    assert got.tolist() == want


def test_score_is_that_of_the_strongest_chunk():
    net = quality_cnn.Network.fresh(3)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abc é!*") for _ in range(n)) for n in (0, 10, 700, 300_000, 2000)]
    got = net.score([*texts, None])
    for text, p in zip([*texts, ""], got, strict=True):
        rows = quality_cnn.chunks(text.encode())
        z = max(net.evidence(net.pooled(rows[k : k + 1], quality_cnn.repeated(rows[k : k + 1]))[0])[0] for k in range(len(rows)))
        assert abs(p - 1 / (1 + math.exp(z))) < 1e-4


def test_gradients():
    net = quality_cnn.Network.fresh(5)
    for name in ("embedding", "filters", "filter_bias", "dense", "dense_bias", "answer", "answer_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    rows = quality_cnn.chunks("some text with * symbols ".encode() * 5)[:1]
    reps = quality_cnn.repeated(rows)

    def loss():
        z = net.evidence(net.pooled(rows, reps)[0])
        return float(np.log1p(np.exp(-z))[0])  # of a bad row

    pooled, at = net.pooled(rows, reps)
    z = net.evidence(pooled)
    grads = quality_cnn._gradients(net, rows, reps, pooled, at, 1 / (1 + np.exp(-z)) - 1)
    rnd = np.random.default_rng(1)
    for name, g in grads.items():
        weights = getattr(net, name)
        for _ in range(4):
            at = tuple(rnd.integers(0, n) for n in weights.shape) if name != "embedding" else (ord("t"), int(rnd.integers(0, 7)))
            old, eps = weights[at], 1e-4
            weights[at] = old + eps
            up = loss()
            weights[at] = old - eps
            down = loss()
            weights[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 0.05 * max(0.02, abs(g[at]))


def _index(seed, neighbours=5):
    rnd = random.Random(seed)
    bad = ["grub", "grubber", "snark", "vile"]
    plain = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(400):
        label = int(rnd.random() < 0.3)
        found = [rnd.choice(plain) for _ in range(rnd.randint(3, 40))]
        found += [rnd.choice(bad) for _ in range(rnd.randint(1, 5) if label else rnd.random() < 0.05)]
        rows.append((str(i), found, label))
    vocabulary = toxicity.Vocabulary(toxicity.telling_terms([(f, y) for _, f, y in rows]))
    idf = np.linspace(1, 3, vocabulary.other + 1)[::-1]
    return toxicity.build(vocabulary, idf, rows, 0.3, neighbours), rows


def as_dict(vector):
    return dict(zip(*(x.tolist() for x in vector), strict=True))


def test_neighbours_are_the_nearest_by_cosine():
    index, rows = _index(1)
    assert "snark" in index.vocabulary.number and "grubb*" in index.vocabulary.number
    vectors = {}
    for _, found, _ in rows:
        v = as_dict(index.vector(found))
        vectors.setdefault(tuple((t, round(x, 9)) for t, x in v.items()), v)
    examples = list(vectors.values())
    assert len(examples) == len(index.sizes) and index.sizes.sum() == len(rows)
    for _, found, _ in rows[:120]:
        vector = index.vector(found + ["snark"])
        v = as_dict(vector)
        cosines = sorted((-sum(x * e.get(t, 0) for t, x in v.items()), i) for i, e in enumerate(examples))[:5]
        got = index.nearest(vector)
        assert [round(s, 9) for s, _ in got] == [round(-s, 9) for s, _ in cosines]


def test_votes_tell_the_classes_apart():
    index, rows = _index(2, 15)
    score = lambda found: index.score(index.nearest(index.vector(found)))
    assert score(["snark", "vile", "grub", "w1", "w2"]) > 0.7
    assert score(["w1", "w2", "w3"]) < 0.3
    assert index.nearest(index.vector([])) == []


def test_isotonic_fit():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.allclose(x, [0.1, 0.25, 0.4]) and np.allclose(y, [0, 0.5, 1])
