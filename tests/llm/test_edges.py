"""Every operator on nulls, empty and very long texts, repeated rows, clashing names and empty tables."""

from collections import Counter

import pytest

import corpus_pipeline
from opsmart.llm import bpe, decontaminate, licenses, perplexity, quality_cnn, secrets, simhash, suffix_dedup, token_counts, toxicity


def _operators(spark, labels):
    bench = spark.createDataFrame([(1, "one"), (None, "two"), (2, None), (3, "")], "item_id long, text string")
    no_labels = labels([])
    return {
        "perplexity": perplexity.quality_rules,
        "decontaminate": lambda d: decontaminate.contaminated(d, bench),
        "licenses": licenses.license_labels,
        "quality": lambda d: quality_cnn.classify(d, no_labels),
        "toxicity": lambda d: toxicity.classify(d, no_labels),
        "secrets": secrets.secret_spans,
        "tokens": token_counts.token_counts,
        "simhash": simhash.near_duplicate_components,
        "bpe": bpe.bpe_round_trip,
        "suffixes": suffix_dedup.removed_windows,
    }


NAMES = ["perplexity", "decontaminate", "licenses", "quality", "toxicity", "secrets", "tokens", "simhash", "bpe", "suffixes"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, frame, labels, odd, name):
    got = _operators(spark, labels)[name](frame(odd)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in odd)
    same = [tuple(r) for r in got if r["doc_id"] == 4]
    assert len(same) == 2 and same[0] == same[1]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, frame, labels, name):
    assert _operators(spark, labels)[name](frame([])).collect() == []


def test_toxicity_without_labels(frame, labels, odd):
    got = toxicity.classify(frame(odd), labels([])).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}


def test_empty_values(spark, frame, labels, odd):
    run = _operators(spark, labels)
    one = lambda name, i: next(r for r in run[name](frame(odd)).collect() if r["doc_id"] == i)
    r = one("decontaminate", 1)
    assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (0, 0, 0, False)
    hits = sorted((r["n_hit"], r["n_items"]) for r in run["decontaminate"](frame(odd)).collect() if r["doc_id"] == 5)
    assert hits == [(1, 0), (1, 1)]  # an item without id marks words but is not listed
    r = one("licenses", 2)
    assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0)
    r = one("tokens", 1)
    assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (0, 0, False)
    r = one("perplexity", 3)
    assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["base_failed"], r["kept"], r["perplexity"]) == (0, 0, 0, True, False, None)
    assert one("simhash", 2)["fingerprint"] == "0" * 16
    assert one("simhash", 3)["component_id"] == 1  # texts without words are linked like any other


def test_pipeline_on_odd_rows(spark, frame, labels, odd, tmp_path):
    frame(odd).write.parquet(f"{tmp_path}/documents.parquet")
    labels([(6, 1, 0, "x")]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # One text without words stays of four; of the two rows of id 4 one; "one" is the benchmark's.
    assert Counter(r["doc_id"] for r in got) == Counter([1, 4, 5, 6, None])


def test_pipeline_on_empty_tables(spark, frame, labels, tmp_path):
    frame([]).write.parquet(f"{tmp_path}/documents.parquet")
    labels([]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
