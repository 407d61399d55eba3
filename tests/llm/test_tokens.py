"""Token counts and BPE against the library itself."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from opsmart.llm import bpe
from opsmart.llm.common import tokenizer_path
from opsmart.llm.token_counts import ChunkedCounter, token_counts

PIECES = ["a", "b", "s", "t", " ", "  ", "\n", " \n", "'s", "7", "é", "É", "<|endoftext|>", "<|startoftext|>", "日本", "!!", "the", "Σ", "ΑΣ", "İ", "½",
          "\x1c", "\x85", "​", "\xa0", "　", "ing", "K", "ſ", "ﬁ", "🙂", "--", "aa", "é"]


def _texts(n, seed):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 80))) for _ in range(n)]
    letters = ["".join(rnd.choice("abcdeist") for _ in range(rnd.randint(1, 40))) for _ in range(n)]
    return made + letters + ["aaaa" * k for k in range(40)] + ["!" * 150 + "x"]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def test_counts_with_any_chunk(byte_bpe):
    rnd = random.Random(5)
    for text in _texts(700, 1):
        want = len(byte_bpe.encode(text, add_special_tokens=False))
        counter = ChunkedCounter(byte_bpe, chunk=rnd.randint(8, 60), overlap=rnd.randint(1, 7))
        assert counter.count([text]) == [want]


def test_text_without_boundary_is_widened(byte_bpe):
    text = "ab" * 400 + " end"
    assert ChunkedCounter(byte_bpe, chunk=16, overlap=4).count([text]) == [len(byte_bpe.encode(text, add_special_tokens=False))]


def test_counts_of_a_table(spark, frame, byte_bpe):
    texts = _texts(60, 2) + ["many words " * 20_000]
    got = {r["doc_id"]: r for r in token_counts(frame(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        n = len(byte_bpe.encode(t, add_special_tokens=False))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len(t.encode()), n, n > 512)


def test_bpe_is_the_library_s():
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.PrefixEncoder(path)
    for text in _texts(1500, 3):
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert own.encode(text) == ids
        assert own.decode(ids) == back
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert own.digests(text) == (len(ids), sha(" ".join(map(str, ids))), sha(back))


def test_bpe_ids_and_text(spark, frame):
    rows = {r["doc_id"]: r for r in bpe.encode(frame([(1, "The thing"), (2, None)])).collect()}
    assert rows[1]["decoded"] == "the</w> thing</w>" and len(rows[1]["ids"]) == 2
    assert rows[2]["ids"] == [] and rows[2]["decoded"] == ""


def test_forgetting_changes_nothing(monkeypatch, byte_bpe):
    from opsmart.llm import token_counts as module

    texts = _texts(200, 4)
    want = [len(byte_bpe.encode(t, add_special_tokens=False)) for t in texts]
    monkeypatch.setattr(module, "_REMEMBERED", 3)
    monkeypatch.setattr(bpe, "_REMEMBERED", 3)
    assert ChunkedCounter(byte_bpe).count(texts) == want
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.PrefixEncoder(path)
    assert [own.digests(t)[0] for t in texts] == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_bpe_over_all_code_points():
    """Characters that were no letters yet when the library's tables were made, or whose case it changes otherwise."""
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.PrefixEncoder(path)
    library.no_truncation()
    library.no_padding()
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for k in range(0, len(points), 1 << 16):
        texts = [f"a{c}B" for c in points[k : k + (1 << 16)]]
        found = library.encode_batch_fast(texts, add_special_tokens=False)
        assert [t for t, e in zip(texts, found, strict=True) if own.encode(t) != e.ids] == []


def test_bpe_with_letters_of_later_tables():
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.PrefixEncoder(path)
    library.no_truncation()
    library.no_padding()
    rnd = random.Random(8)
    odd = ["՘", "Ᲊ", "Ɤ", "\U00018e00", "\U000323b0", "\U00010d50", "Σ", "İ", "é", "é", "A", " ", "'s", "7", "!"]
    for _ in range(3000):
        text = "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 12)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_frequent_texts_are_remembered():
    """Texts that come again and again are made once, however many others pass in between."""
    made = []
    known = bpe._Remembered(lambda x: made.append(x) or x.upper(), 20)
    for k in range(200):
        assert known[f"rare{k}"] == f"RARE{k}" and known["often"] == "OFTEN"
    assert made.count("often") == 1 and len(known) <= 10
    long = "x" * (bpe._LONGEST + 1)
    assert known[long] == long.upper() and long not in known
