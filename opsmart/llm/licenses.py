"""License scans: ordered signature rules, in DataFrame operations only.

A rule is a regular expression over the words of a text (lower case, one blank between words), with a label, a priority,
a confidence and the words that must all be present before the expression is tried. Hundreds of rules are built
from the names, short names and versions of licenses and a few phrasings. Detections are intervals of words. Going
through them from left to right, the longer and then the higher-ranked first, a detection that lies within
one already kept is dropped: "gpl 3" within "released under the gpl 3" says nothing new.

All of it happens within a row: no shuffle, no join. Only texts with some rule's words are looked at more
closely, and work on a text is linear in its words and detections.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.llm.common import WORD_CLASS, ascii_lower

#: Phrases that always count, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Names of licenses (words; ``|`` between alternatives), their label and their versions.
FAMILIES = [
    ("gpl", "gnu general public license|general public license|gnu gpl|gpl", "1.0 2.0 3.0"),
    ("lgpl", "lesser general public license|library general public license|gnu lgpl|lgpl", "2.0 2.1 3.0"),
    ("agpl", "affero general public license|gnu agpl|agpl", "1.0 3.0"),
    ("gfdl", "free documentation license|gfdl", "1.1 1.2 1.3"),
    ("apache", "apache software license|apache license|apache", "1.0 1.1 2.0"),
    ("mpl", "mozilla public license|mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public license|epl", "1.0 2.0"),
    ("cddl", "common development and distribution license|cddl", "1.0 1.1"),
    ("cpl", "common public license", "1.0"),
    ("eupl", "european union public licence|european union public license|eupl", "1.0 1.1 1.2"),
    ("osl", "open software license", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "academic free license", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic license", "1.0 2.0"),
    ("lppl", "latex project public license|lppl", "1.0 1.1 1.2 1.3"),
    ("ofl", "sil open font license|open font license", "1.0 1.1"),
    ("ecl", "educational community license", "1.0 2.0"),
    ("apsl", "apple public source license|apsl", "1.0 1.1 1.2 2.0"),
    ("php", "php license", "3.0 3.01"),
    ("zpl", "zope public license", "1.1 2.0 2.1"),
    ("cecill", "cecill license|cecill", "1.0 2.0 2.1"),
    ("boost", "boost software license", "1.0"),
    ("odbl", "open database license|odbl", "1.0"),
    ("odc-by", "open data commons attribution license", "1.0"),
    ("pddl", "public domain dedication and license|pddl", "1.0"),
    ("cc0", "cc0|creative commons zero", "1.0"),
    ("python", "python software foundation license|psf license|python license", "2.0"),
    ("ms-pl", "microsoft public license", ""),
    ("ms-rl", "microsoft reciprocal license", ""),
    ("mit", "mit license|mit licence|mit", ""),
    ("x11", "x11 license", ""),
    ("expat", "expat license", ""),
    ("isc", "isc license|isc licence", ""),
    ("zlib", "zlib license|zlib libpng license", ""),
    ("bsd", "bsd license|bsd licence|bsd", ""),
    ("bsd-2-clause", "bsd 2 clause|2 clause bsd|simplified bsd|freebsd license", ""),
    ("bsd-3-clause", "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd", ""),
    ("bsd-4-clause", "bsd 4 clause|4 clause bsd|original bsd", ""),
    ("0bsd", "0bsd|zero clause bsd", ""),
    ("unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl|do what the fuck you want to public license", ""),
    ("beerware", "beerware license|beer ware license", ""),
    ("curl", "curl license", ""),
    ("openssl", "openssl license", ""),
    ("postgresql", "postgresql license", ""),
    ("ncsa", "university of illinois ncsa open source license|ncsa license", ""),
    ("ruby", "ruby license", ""),
    ("vim", "vim license", ""),
]
#: The Creative Commons terms and versions.
CC_TERMS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?", "nc": "non ?commercial"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: Sentences of license texts and notices, with their label.
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of(?: \\w+){1,8} nor the names of its contributors may be used to endorse or promote"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "confidential and proprietary"),
    ("proprietary", "unauthorized copying of this file"),
    ("no-ai-training", "may not be used (?:to train|for training)(?: \\w+){0,6} (?:models?|ai)"),
]
_UNDER = "under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    needs: tuple[str, ...]
    priority: int
    confidence: float


def _needed(pattern: str) -> tuple[str, ...]:
    """The words a match must hold: whole words outside every group. A group that ends or begins with a blank leaves
    its neighbours whole; with any other group, or an optional blank, they may be parts of words."""

    def gone(m: re.Match) -> str:
        return " " if m["body"][:1] == " " or m["body"][-1:] == " " else "\0"

    flat = pattern.replace(" ?", "\0")
    while (shorter := re.sub(r"\((?:\?[:!])?(?P<body>[^()]*)\)(?:[?*]|\{[^}]*\})?", gone, flat)) != flat:
        flat = shorter
    return tuple(dict.fromkeys(w for w in flat.split(" ") if re.fullmatch(r"[a-z0-9]+", w)))


def _version(v: str) -> str:
    major, minor = v.split(".")
    return f"(?: version| ver| v)? (?:v)?{major}(?: 0)?(?! \\d)" if minor == "0" else f"(?: version| ver| v)? (?:v)?{major} {minor}"


def _rules() -> list[Rule]:
    found: list[Rule] = []

    def add(label: str, pattern: str, priority: int, confidence: float) -> None:
        found.append(Rule(label, pattern, _needed(pattern), priority, confidence))

    def phrased(label: str, name: str, words: str, lone: bool) -> None:
        """A license called ``name``, by itself, granted, or (``words``) as a machine-readable tag."""
        if lone:
            add(label, name, 20, 0.6)
        add(label, f"{_UNDER}{name}(?: or (?:\\(at your option\\) )?(?:any )?later(?: version)?)?", 80, 1.0)
        if words:
            add(label, f"spdx license identifier {words}", 100, 1.0)

    for label, names, versions in FAMILIES:
        tag = label.replace("-", " ")
        for k, name in enumerate(names.split("|")):
            # A single everyday word is no license by itself ("mit" is also a German word).
            lone = " " in name or name not in ("mit", "bsd", "apache", "unlicense")
            phrased(label, name, "" if k or versions else tag, lone)
            for v in versions.split():
                phrased(f"{label}-{v}", name + _version(v), "" if k else f"{tag} {v.replace('.', ' ')}", True)
    for term in CC_TERMS:
        short = "cc " + term.replace("-", " ")
        long = "creative commons " + " ".join(CC_WORDS[x] for x in term.split("-"))
        more = "(?! (?:sa|nd|nc)\\b)"
        phrased(f"cc-{term}", short + more, short + more, True)
        phrased(f"cc-{term}", long, "", True)
        for v in CC_VERSIONS:
            for name in (short, long + "(?: (?:international|unported|generic))?"):
                phrased(f"cc-{term}-{v}", name + _version(v), "", True)
    for label, text in TEXTS:
        add(label, text, 90, 0.95 if len(text) > 30 else 0.7)
    return found


RULES = _rules()
_OPEN, _CLOSE = "\x01", "\x02"


def _literal_rules() -> Column:
    base = [Rule(label, phrase, tuple(phrase.split()), -1, 0.0) for phrase, label in BASE.items()]
    return F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"),
                F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
                F.array(*map(F.lit, r.needs)).alias("needs"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
            )
            for r in [*base, *RULES]
        ]
    )


def _places(line: Column, rule: Column) -> Column:
    """Intervals of words at which a rule matches.

    Matches are set between two marks; a mark's place in the list of words, less the marks before it, is a word's place.
    """
    marked = F.split(F.trim(F.regexp_replace(line, rule["pattern"], f"{_OPEN} $0 {_CLOSE}")), " ", -1)

    def at(mark: str, first: int) -> Column:
        seen = F.filter(F.transform(marked, lambda w, i: F.when(w == mark, i)), lambda i: i.isNotNull())
        return F.transform(seen, lambda i, k: (i - 2 * k - first).cast("long"))

    return F.zip_with(
        at(_OPEN, 0),
        at(_CLOSE, 1),
        lambda a, b: F.struct(
            a.alias("start"),
            (-b).alias("minus_end"),
            (-rule["priority"]).alias("minus_priority"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        ),
    )


def detections(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, found, kept`` for every row.

    ``found`` lists all detections, ``kept`` those that no other suppresses, each as ``start, end`` (words from 0, end
    exclusive), ``label, confidence``; detections of the base phrases have confidence 0 in ``found``.
    """
    needed = sorted({w for r in RULES for w in r.needs} | {w for phrase in BASE for w in phrase.split()})
    text = F.coalesce(F.col("text"), F.lit(""))
    empty = F.array().cast(
        "array<struct<start:bigint,minus_end:bigint,minus_priority:int,label:string,confidence:double>>"
    )
    out = "array<struct<start:bigint,end:bigint,label:string,confidence:double>>"
    rows = (
        # The Unicode lower case of a word equals a rule's word whenever its ASCII lower case does.
        docs.select("doc_id", text.alias("text"), F.regexp_extract_all(F.lower(text), F.lit(WORD_CLASS), F.lit(0)).alias("words"))
        .select("doc_id", "text", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", F.array(*map(F.lit, needed))).alias("here"))
        .select(
            "doc_id",
            "text",
            "n_words",
            F.when(F.size("here") > 0, F.filter(_literal_rules(), lambda r: F.size(F.array_except(r["needs"], F.col("here"))) == 0)).alias("tried"),
        )
        .select(
            "doc_id",
            "n_words",
            "tried",
            F.when(
                F.size("tried") > 0,
                F.concat(F.lit(" "), F.concat_ws(" ", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD_CLASS), F.lit(0))), F.lit(" ")),
            ).alias("line"),
        )
        .select(
            "doc_id",
            "n_words",
            F.coalesce(
                F.when(F.col("line").isNotNull(), F.array_sort(F.flatten(F.transform("tried", lambda r: _places(F.col("line"), r))))), empty
            ).alias("found"),
        )
    )

    def keep(state: Column, d: Column) -> Column:
        inside = (d["minus_priority"] > 0) | (-d["minus_end"] <= state["reach"])  # base phrases do not compete
        return F.when(inside, state).otherwise(
            F.struct(
                (-d["minus_end"]).alias("reach"),
                F.array_append(state["kept"], d).alias("kept"),
            )
        )

    start = F.struct(F.lit(-1).cast("long").alias("reach"), empty.alias("kept"))
    plain = lambda d: F.struct(d["start"], (-d["minus_end"]).alias("end"), d["label"], d["confidence"])
    return rows.select(
        "doc_id",
        "n_words",
        F.transform("found", plain).cast(out).alias("found"),
        F.when(F.size("found") > 0, F.transform(F.aggregate("found", start, keep)["kept"], plain))
        .otherwise(F.array())
        .cast(out)
        .alias("kept"),
    )


def license_labels(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``.

    A null or empty text has no words, no places (null), empty labels and score 0. Rows are
    scanned by themselves; repeated rows give repeated results and an empty table an
    empty one. The score is the highest confidence of a kept detection, 0.6 at least where a base phrase stands.
    """
    found = detections(docs)
    base = F.filter("found", lambda d: d["confidence"] == 0)
    rows = found.select("doc_id", "n_words", base.alias("base"), "kept")
    starts = F.transform("base", lambda d: d["start"])
    labels = lambda c: F.transform(c, lambda d: d["label"])
    best = F.coalesce(F.array_max(F.transform("kept", lambda d: d["confidence"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(labels("base")))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(labels("base"), labels("kept"))))).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.6).otherwise(0.0)).alias("score"),
    )
