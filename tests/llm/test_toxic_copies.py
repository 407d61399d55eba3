"""A near copy of a labelled example is found by its whole text, whatever words it is made of."""

import pickle
import random
import zlib

import numpy as np
import pytest

from opsmart.llm import toxicity


@pytest.fixture
def tables(frame, labels):
    rnd = random.Random(5)
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 != 1][:201]
    texts, marks = [], []
    for n, i in enumerate(ids[:-1]):
        toxic = int(n < 60)
        found = [f"w{rnd.randrange(300)}" for _ in range(30)]
        # the first toxic texts have none of the words that tell the classes apart
        found += ["grub", "snark"] if 10 <= n < 60 else []
        texts.append((i, " ".join(found)))
        marks.append((i, 1, toxic, "x"))
    copies = [(10_000 + n, texts[n][1] + " unseen") for n in (0, 5, 100)]
    return frame(texts + copies), labels(marks), texts, copies


def test_near_copies_are_found(tables):
    docs, marks, texts, copies = tables
    rows = {r["doc_id"]: r for r in toxicity.classify(docs, marks).collect()}
    for n, (i, _) in zip((0, 5, 100), copies, strict=True):
        name, label, similarity = rows[i]["evidence"].split(",")[0].split(":")
        assert name == str(texts[n][0]) and float(label) == (n < 60) and float(similarity) > 0.9
    assert rows[10_000]["score"] > rows[10_100]["score"]


def test_examples_stay_apart(tables):
    docs, marks, texts, _ = tables
    index, _ = toxicity.fit(docs, marks)
    assert len(index.sizes) == len(texts) and {w for _, t in texts for w in t.split()} <= index.vocabulary.number.keys()


def test_contradictory_labels_of_one_text_both_count(frame, labels):
    rnd = random.Random(6)
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 != 1][:120]
    texts = [(i, " ".join(f"w{rnd.randrange(200)}" for _ in range(25))) for i in ids]
    twice = [(ids[0], texts[0][1]), (ids[1], texts[0][1]), (ids[2], texts[0][1])]
    docs = frame(twice + texts[3:])
    marks = labels([(ids[0], 1, 1, "x"), (ids[1], 1, 0, "x"), (ids[2], 1, 0, "x"), *[(i, 1, n % 2, "x") for n, i in enumerate(ids[3:])]])
    rows = {r["doc_id"]: r["evidence"] for r in toxicity.classify(docs, marks).collect()}
    assert rows[ids[0]].split(",")[0].split(":")[1] == "0.50"  # once toxic, once not


@pytest.mark.parametrize("terms, counts", [([], []), ([0], [1]), ([0, 1, 7], [1, 2, 300]), ([5, 70_000, 20_000_000], [2**31, 1, 65_536])])
def test_packed_terms_come_back(terms, counts):
    got = toxicity.unpacked(toxicity.packed(np.array(terms, np.int64), np.array(counts, np.int64)))
    assert [x.tolist() for x in got] == [terms, counts]


def test_index_travels_without_its_tables_of_blocks():
    rng = random.Random(8)
    texts = [([f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 30))], rng.randrange(2)) for _ in range(300)]
    vocabulary = toxicity.Vocabulary(toxicity.all_terms(texts))
    index = toxicity.build(vocabulary, np.ones(vocabulary.other + 1), [(str(i), found, label) for i, (found, label) in enumerate(texts)], 0.3, 15)
    sent = pickle.dumps(index)
    back = pickle.loads(sent)
    assert (back.starts == index.starts).all() and (back.block_max == index.block_max).all()
    assert index.block_max.nbytes and not {"starts", "block_max"} & index.__getstate__().keys()
    for found, _ in texts[:50]:
        assert back.nearest(back.vector(found)) == index.nearest(index.vector(found))
