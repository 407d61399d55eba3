"""The pipeline's stages against brute force, on a small corpus."""

import hashlib
import os
import random

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from opsmart.llm.common import tokenizer_path
from opsmart.llm.secrets import redact_text
from opsmart.llm.simhash import fingerprint
from tests.llm.test_exact import brute_components, brute_hits

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        out = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "test")
        after = {r["doc_id"]: r.asDict() for r in out.collect()}
        if name != names[-1]:
            assert out.columns == docs.columns
        if name == names[0]:
            assert 0.6 * len(before) < len(after) < len(before)
            assert all(after[r["doc_id"]] == r for r in before if r["doc_id"] in after)
        elif name == names[1]:
            roots = brute_components([fingerprint(r["text"]) for r in before])
            least = {q: min(r["doc_id"] for r, p in zip(before, roots, strict=True) if p == q) for q in roots}
            assert set(after) == set(least.values())
        elif name == names[2]:
            assert set(after) == {r["doc_id"] for r in before if not brute_hits_any(r["text"], bench)}
        elif name == names[3]:
            assert {i: r["text"] for i, r in after.items()} == {r["doc_id"]: redact_text(r["text"]) for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
            for r in before:
                ids = library.encode(r["text"], add_special_tokens=False).ids
                assert after[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        docs = out


def brute_hits_any(text, bench):
    """``brute_hits`` for texts that share a word run with an item at all, found by their windows."""
    from tests.llm.test_exact import words

    ws = words(text)
    windows = {}
    for _, item in bench:
        iw = words(item)
        k = min(10, len(iw))
        for s in range(len(iw) - k + 1 if k else 0):
            windows.setdefault(k, set()).add(tuple(iw[s : s + k]))
    return any(tuple(ws[p : p + k]) in own for k, own in windows.items() for p in range(len(ws) - k + 1))


def test_brute_forces_agree():
    rnd = random.Random(1)
    items = [(1, "a b c d e f g h i j k l"), (2, "x y")]
    for _ in range(200):
        text = " ".join(rnd.choice(["a b c d e f g h i j", "k l", "x", "y", "q"]) for _ in range(4))
        assert brute_hits_any(text, items) == brute_hits(text, items, 10)[4]


def test_queries_are_registered():
    runs = entry.queries()
    numbers = sorted(int(k[2:].split("_")[0]) for k in runs if k.startswith("op") and k[2].isdigit())
    assert numbers == list(range(1, 11)) and "pipeline" in runs
    assert set(entry.oracle_sql()) <= set(runs)
