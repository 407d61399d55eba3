"""Files of token ids: round trips of the format, and whole tables against the library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from opsmart.llm import token_files as tf
from opsmart.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, tf.END_ID]


@pytest.mark.parametrize("kind", [tf.BYTE_PLANES, tf.BIT_PLANES])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 63, 64, 65, 1000])
def test_round_trip(kind, n):
    rnd = np.random.default_rng(n)
    for top in (1, 2, 255, 256, 50_257, 2**32):
        ids = rnd.integers(0, top, n, dtype=np.uint64).astype("<u4")
        file = tf.IdFile(tf.pack(ids, block=64, kind=kind))
        assert file.n_ids == n and [c.n_ids for c in file.chunks] == [min(64, n - k) for k in range(0, n, 64)]
        assert (file.ids() == ids).all()
        for _ in range(10):
            a, b = sorted(int(x) for x in rnd.integers(0, n + 3, 2))
            assert file.ids(a, b).tolist() == ids[a:b].tolist()


def test_a_range_reads_its_chunks_only():
    data = bytearray(tf.pack(np.arange(1000, dtype="<u4"), block=100))
    whole = tf.IdFile(bytes(data))
    place = whole.chunks[0].place
    data[place : place + sum(whole.chunks[0].sizes)] = bytes(sum(whole.chunks[0].sizes))
    damaged = tf.IdFile(bytes(data))
    assert damaged.ids(100, 350).tolist() == list(range(100, 350))
    with pytest.raises(Exception):
        damaged.ids(99, 350)


def test_damage_is_noticed():
    data = tf.pack(np.arange(1000, dtype="<u4"), block=100)
    with pytest.raises(ValueError):
        tf.IdFile(data[:20])
    with pytest.raises(ValueError):
        tf.IdFile(b"XXXX" + data[4:])
    with pytest.raises(ValueError):
        tf.IdFile(data[:-60] + bytes([data[-60] ^ 1]) + data[-59:])


PIECES = ["a", "b", "s", "t", " ", "  ", "\n", " \n", "'s", "7", "é", "<|endoftext|>", "日本", "!!", "the", "\x1c", "\x85", "\xa0", "　", "ing", "🙂", "--"]


def test_encoder_is_the_library(byte_bpe):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["", " ", "x" * 5000]
    for remembered in (0, 5, 100_000):
        got = tf.IdEncoder(byte_bpe, remembered).encode_all(texts)
        want = [ids_of(byte_bpe, t)[:-1] for t in texts]
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == want


def test_all_code_points_between_letters(byte_bpe):
    """Whatever the library takes for white space, units are cut where it cuts."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 97 == 0)]
    texts = [f"ab{c} {c}cd {c}" for c in points]
    got = tf.IdEncoder(byte_bpe).encode_all(texts)
    want = byte_bpe.encode_batch(texts, add_special_tokens=False)
    assert [t for t, g, w in zip(texts, got, want, strict=True) if np.frombuffer(g, "<u4").tolist() != w.ids] == []


def test_whole_table(spark, frame, byte_bpe):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["some", "words", "in", "any\norder", "  "]) for _ in range(rnd.randint(0, 300)))) for i in range(400)]
    rnd.shuffle(rows)
    want, start = {}, 0
    for i, text in sorted(rows):
        ids = ids_of(byte_bpe, text)
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    for options in ({}, {"block": 64, "file_ids": 500, "kind": tf.BIT_PLANES}):
        got = tf.token_files(frame(rows).repartition(5), **options).collect()
        assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got} == want


def test_chunk_index(spark, frame, tmp_path):
    folder = f"{tmp_path}/files"
    tf.write_token_files(frame([(i, "word " * i) for i in range(100)]), folder, block=100, file_ids=1000)
    index = sorted(tf.chunk_index(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in index] == [0, *np.cumsum([r["n_ids"] for r in index])[:-1].tolist()]
    total = sum(r["n_tokens"] for r in tf.read_token_files(spark, folder).collect())
    assert sum(r["n_ids"] for r in index) == total and max(r["n_ids"] for r in index) == 100


def test_odd_rows(spark, frame, odd, byte_bpe):
    got = tf.token_files(frame(odd)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted([i for i, _ in odd], key=lambda i: (i is not None, i))
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == sorted((i or -1, len(ids_of(byte_bpe, t))) for i, t in odd)
    starts = np.cumsum([0, *[r["n_tokens"] for r in got]])
    assert [r["start"] for r in got] == starts[:-1].tolist()
    assert tf.token_files(frame([])).collect() == []
