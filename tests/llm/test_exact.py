"""Operators against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from opsmart.llm import decontaminate, licenses, perplexity, simhash, suffix_dedup
from opsmart.llm.components import connected_components

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


# --- benchmark decontamination ---------------------------------------------------------------------------


def brute_hits(text, items, size):
    ws = words(text)
    hit, found = set(), set()
    for item, it in items:
        iw = words(it)
        k = min(size, len(iw))
        for s in range(len(iw) - k + 1 if k else 0):
            for p in range(len(ws) - k + 1):
                if ws[p : p + k] == iw[s : s + k]:
                    hit.update(range(p, p + k))
                    found.add(str(item))
    ids = ",".join(sorted(found))
    return len(ws), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def passages(seed, n_items=12, n_docs=60):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "a", "to"] * 4 + [f"w{i}" for i in range(25)] + ["Éa", "éA", "Kelvin", "kelvin", "x9"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 3, 6, 9, 10, 11, 15, 30]))) for i in range(n_items)] + [(97, ""), (98, "?!"), (99, "the the the the")]
    items.append((100, items[3][1]))
    docs = []
    for i in range(n_docs):
        body = text(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            iw = rnd.choice(items)[1].split()
            a = rnd.randint(0, len(iw))
            body += " " + rnd.choice([" ", ", ", "\n"]).join(iw[a : a + rnd.randint(1, 20)]).upper() + " " + text(rnd.randint(0, 5))
        docs.append((i, body))
    return items, docs


@pytest.mark.parametrize("size", [10, 4])
def test_contamination(spark, frame, size):
    items, docs = passages(size)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contaminated(frame(docs), bench, size).collect()}
    assert got == {i: brute_hits(t, items, size) for i, t in docs}


def test_contamination_matches_its_sql(spark, frame):
    import duckdb
    import pandas as pd

    items, docs = passages(7)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = sorted(con.execute(decontaminate.SQL).fetchall())
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.contaminated(frame(docs), bench).collect()) == want


def test_proximity(spark, frame):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    texts = ["alpha one two beta x x x x gamma delta", "alpha" + " x" * 40 + " beta gamma delta", "alpha beta gamma delta", "alpha beta"]
    common = " gamma delta" * 3  # makes alpha and beta the rarest
    docs = [(i, t + " |" + " y" * 30 + common) for i, t in enumerate(texts)]
    got = {r["doc_id"] for r in decontaminate.proximity_matches(frame(docs), bench, slop=3).collect()}
    assert got == {0, 2, 3}
    assert {r["doc_id"] for r in decontaminate.clean(frame(docs), bench).collect()} == {0, 1, 3}


# --- licenses ---------------------------------------------------------------------------------------------


def brute_license(text):
    ws = words(text)
    line = " " + " ".join(ws) + " "
    at = lambda c: line[:c].count(" ") - 1
    base = sorted((at(m.start()), label) for p, label in licenses.BASE.items() for m in re.finditer(f"(?<= )(?:{p})(?= )", line))
    found = sorted(
        (at(m.start()), -(at(m.end()) + 1), -r.priority, r.label, r.confidence)
        for r in licenses.RULES
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line)
    )
    reach, kept = -1, []
    for d in found:
        if -d[1] > reach:
            kept.append(d)
            reach = -d[1]
    labels = {x[1] for x in base} | {d[3] for d in kept}
    score = max([d[4] for d in kept] + [0.6 if base else 0.0])
    starts = [x[0] for x in base]
    return (len(ws), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x[1] for x in base})), ",".join(sorted(labels)), score)


LICENSES = [
    None, "", "no license here", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "licensed under CC BY-NC 4.0 and cc-by",
    "This work is licensed under the GNU General Public License, version 3.", "under the terms of the GNU Lesser General Public License v2.1 or later",
    "mit License, MIT LICENSE; mit Licence", "SPDX-License-Identifier: Apache-2.0", "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mit dem Hund, all rights reserved", "Neither the name of the Foo Bar nor the names of its contributors may be used to endorse or promote",
    "gpl gnu general public license apache license cc by mit license " * 3, "Creative Commons Attribution ShareAlike 3.0", "lgpl 3 lgpl 30 bsd 3 clause",
    "Key MIT İ license mit license", "cc\x01by \x02 cc by",
]


def test_licenses(frame):
    rows = {r["doc_id"]: tuple(r)[1:] for r in licenses.license_labels(frame(list(enumerate(LICENSES)))).collect()}
    assert rows == {i: brute_license(t) for i, t in enumerate(LICENSES)}


def test_hundreds_of_rules_with_needed_words():
    assert len(licenses.RULES) > 300
    assert all(r.needs for r in licenses.RULES)


# --- SimHash ------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    ws = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("long_list", [1, 3, 32])
def test_links_of_fingerprints(spark, long_list):
    rnd = random.Random(long_list)
    centres = [rnd.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    fps = []
    for _ in range(220):
        x = rnd.choice(centres)
        for _ in range(rnd.randint(0, 4)):
            x ^= 1 << rnd.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = connected_components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), long_list))
    roots = {r["node"]: r["root"] for r in found.collect()}
    want = brute_components(fps)
    groups, own = {}, {}
    for x, r in zip(signed, want, strict=True):
        groups.setdefault(r, set()).add(x)
        own.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))
    assert all(k == min(v) for k, v in own.items())


def test_near_duplicates(frame):
    rnd = random.Random(2)
    text = lambda: " ".join(rnd.choice("ab cd ef gh ij kl É".split()) for _ in range(rnd.randint(1, 300)))
    docs = [(100 + i, text()) for i in range(40)]
    for i in range(60):
        ws = rnd.choice(docs)[1].split()
        ws[rnd.randrange(len(ws))] = "zz"
        docs.append((10 + i, " \n".join(ws).upper().replace("É", "É")))
    docs += [(5, None), (6, ""), (7, "x y")]
    fps = [brute_fingerprint(t) for _, t in docs]
    roots = brute_components(fps)
    least = {r: min(i for (i, _), q in zip(docs, roots, strict=True) if q == r) for r in roots}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicate_components(frame(docs)).collect()}
    assert got == {i: (f"{f:016x}", least[r]) for (i, _), f, r in zip(docs, fps, roots, strict=True)}
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(frame(docs)).collect()}
    assert kept == set(least.values())


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (None, 4), (900, 901)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {901: 900}


# --- repeated windows ---------------------------------------------------------------------------------------


def brute_windows(texts, size):
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if counts[b[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(x for x, g in zip(b, gone[:-1], strict=True) if not g)
        out.append((len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("part", [2048, 2])
def test_repeated_windows(spark, part):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdé ") for _ in range(200)) for _ in range(3)]
    texts = [None, "", "x" * 39, "x" * 40, "x" * 200, "yz" * 90]
    for _ in range(110):
        s = rnd.choice(base)
        a = rnd.randint(0, 150)
        t = s[a : a + rnd.randint(10, 120)]
        if rnd.random() < 0.5:
            t = t[: rnd.randint(0, len(t))] + rnd.choice("XYZ") + t[rnd.randint(0, len(t)) :]
        if rnd.random() < 0.3:
            t = t * 2
        texts.append("".join(rnd.choice("pqrst") for _ in range(rnd.randint(0, 30))) + t)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    rows.append(rows[20])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_windows([t for _, t in rows], 40), strict=True))
    assert Counter(tuple(r) for r in suffix_dedup.removed_windows(docs, 40, part).collect()) == want


def test_a_part_tells_a_block_once(spark, monkeypatch):
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(160))
    cuts = [(rnd.randrange(160), rnd.choice("VWXYZ")) for _ in range(60)]
    rows = [(i, base[:a] + c + base[a:]) for i, (a, c) in enumerate(cuts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tables, keep = {}, suffix_dedup.materialise
    monkeypatch.setattr(suffix_dedup, "materialise", lambda df, purpose: tables.setdefault(purpose, keep(df, purpose)))
    got = Counter(tuple(r) for r in suffix_dedup.removed_windows(docs, 40, 4).collect())
    assert got == Counter((i, *x) for (i, _), x in zip(rows, brute_windows([t for _, t in rows], 40), strict=True))
    told = {k: {(r["anchor"], r["salt"], r["digest"]) for r in tables["settled"].where(f"kind = '{k}'").collect()} for k in ("left", "seen")}
    assert told["left"] and told["seen"]
    assert not told["left"] & told["seen"]


def test_runs_do_not_depend_on_the_stretch(monkeypatch):
    data = "".join(random.Random(1).choice("abcd") for _ in range(5000)).encode()
    covered = lambda: [(int(s), int(p)) for lo, hi, p, _ in zip(*suffix_dedup.runs(data, 100), strict=True) for s in range(lo, hi + 1)]
    want = covered()
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 333)
    assert covered() == want


# --- quality rules ------------------------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    ws = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search("[^\x20\x09-\x0d]", line))
        seen.add(line)
    counts = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if counts[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_counts():
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b ", "c ", " ", "\n", "\n", "\t", "\xa0", "\x1f", "#", "é ", "||", "a b c "]) for _ in range(rnd.randint(0, 60)))
        assert perplexity.base_counts(text) == brute_base(text)
    assert perplexity.base_counts("a a a a") == (4, 4, 0, 0, 4)


def test_model_sums_to_one_and_uses_all_counts(frame):
    docs = frame([(i, "the cat sat on the mat and the dog sat on the log " * 3) for i in range(5)])
    texts = perplexity._texts(docs)
    counts = {r["gram"]: r["n"] for r in perplexity.count_ngrams(texts, ["en"]).collect()}
    assert sum(counts.values()) == sum(len(r["text"]) for r in docs.collect())
    model = perplexity.fit(texts, ["en"])["en"]
    for context in ("the", "qzx", " at"):
        c = perplexity.symbols(context).astype(int)
        head = ((int(c[0]) << 10) | (int(c[1]) << 5) | int(c[2])) << 5
        total = sum(np.exp(model.log_probability(np.array([head | w], np.int32))) for w in range(perplexity.CLASSES))
        assert abs(total - 1) < 1e-5
    again = perplexity.Model.unpack(model.pack())
    keys = next(perplexity.packed("the dog"))
    assert again.log_probability(keys) == model.log_probability(keys)


def test_kneser_ney_by_its_definition():
    rnd = random.Random(6)
    text = "".join(rnd.choice("ab c") for _ in range(400))
    s = [0, 0, 0, *perplexity.symbols(text).tolist()]
    grams = [tuple(s[i : i + 4]) for i in range(len(s) - 3)]
    tables = {4: Counter(grams)}
    for order in (3, 2, 1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    offs = {}
    for order, t in tables.items():
        n = [0, *[sum(c == k for c in t.values()) for k in range(1, 5)]]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        offs[order] = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5, 0.05), k - 0.05) if n[1] else 0.5 for k in (1, 2, 3)]

    def p(gram):
        if not gram:
            return 1 / perplexity.CLASSES
        order = len(gram)
        t = {g: c for g, c in tables[order].items() if g[:-1] == gram[:-1]}
        if not t:
            return p(gram[1:])
        total, off = sum(t.values()), offs[order]
        room = sum(off[min(c, 3) - 1] for c in t.values()) / total
        c = t.get(gram, 0)
        return (c - (off[min(c, 3) - 1] if c else 0)) / total + room * p(gram[1:])

    keys = next(perplexity.packed(text))
    model = perplexity.Model.build(*np.unique(keys, return_counts=True))
    for text in ("ab c", "zzzz", "a zb", "cab "):
        g = tuple(perplexity.symbols(text).tolist())
        key = (g[0] << 15) | (g[1] << 10) | (g[2] << 5) | g[3]
        assert abs(model.log_probability(np.array([key], np.int32)) - np.log(p(g))) < 1e-4


def test_bands_reject_by_language(spark):
    rnd = random.Random(8)
    letters = {"en": "aeinost", "xx": "ugwzkrl"}
    word = lambda lang: "".join(rnd.choice(letters[lang]) for _ in range(rnd.randint(2, 7)))
    langs = ["en" if i % 2 else "xx" for i in range(200)]
    rows = [(i, " ".join(word(lang) for _ in range(rnd.randint(60, 400))), lang) for i, lang in enumerate(langs)]
    rows += [(900, rows[1][1].replace(" ", "#*%&<> "), "en"), (901, rows[0][1], "en"), (902, "word", "en"), (903, "a b c " * 40, "xx"), (904, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in perplexity.quality_rules(docs).collect()}
    assert all(got[i]["kept"] for i in range(200))
    assert not got[900]["kept"] and not got[901]["kept"] and not got[901]["base_failed"]
    assert got[902]["base_failed"] and got[903]["base_failed"] and got[904]["base_failed"]
