"""Words cut at their gaps: the same as words matched one by one, and cut once."""

import contextlib
import io

from pyspark.sql import functions as F

from opsmart.llm import decontaminate
from opsmart.llm.common import WORD_CLASS


def test_words_are_those_of_the_class(spark):
    texts = [None, "", " ", "...", "a", " a", "a ", "-a--b-", "Ünï 12_x\x00y\x7fz", "𝔸b\n\nc", "日本 語!", "Σίσυφος'Α", "퟿\U0010ffff"]
    texts.append("".join(chr(c) + ("a" if c % 3 else "") for c in range(0x250)))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    old = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD_CLASS), F.lit(0))
    for r in df.select("text", decontaminate.words_of(F.col("text")).alias("new"), old.alias("old")).collect():
        assert r["new"] == r["old"], r["text"]


def test_a_pass_cuts_each_text_once(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    terms = spark.createDataFrame([("two",)], "key string")
    counted = decontaminate._found(decontaminate._occurrences(docs).select("key"), terms).groupBy("key").count()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        counted.explain()
    assert "regexp_extract_all" not in out.getvalue()
    assert out.getvalue().count("split(") == 1
