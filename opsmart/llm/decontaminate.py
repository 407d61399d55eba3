"""Benchmark decontamination through a positional inverted index, in DataFrame operations only.

The training side is indexed once for the words that the benchmark needs: a posting is (word,
document, position), with the few words around it. Counting the benchmark's words over all documents
comes first; each window of an item is then looked up through its two rarest words. Their lists are
shifted by the words' places in the item, so that an occurrence of the window has the same shift
in both, and intersected. What is left is compared word by word with the stored
surroundings, which gives the maximal equal run around the rarest word. A window occurs exactly if
it lies within such a run.

No side is broadcast by order: the benchmark's words are a written table whose size Spark knows, and it
picks the join. A word, window or document with very many hits is linear in its occurrences; nothing is
gathered for a word, and for a document at most its own hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmart.llm.common import WORD_GAP, ascii_lower
from opsmart.session import materialise


def words_of(text: Column) -> Column:
    """Words of the whole text in their own case; a null text has none. Split at the gaps, which costs a fifth of matching each word."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def _lowered(words: Column) -> Column:
    return F.transform(words, ascii_lower)


def _documents(docs: DataFrame) -> DataFrame:
    """``_doc`` identifies a document by id and text, so equal rows are one and different texts never mix."""
    return docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("_doc"), "text")


def _items(benchmark: DataFrame) -> DataFrame:
    words = benchmark.select("item_id", _lowered(words_of(F.col("text"))).alias("words"))
    return words.where(F.size("words") > 0).distinct().withColumn("item", F.struct("item_id", F.xxhash64("words").alias("h")))


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every word of every document: its place (from 1), its key, and the document's words.

    Each document begins with an empty word at place 0, whose row stands for the document itself. No list is empty, so the
    outer form gives the same rows; the inner one makes Spark filter by the size of the list, for which it cuts the text a second time.
    """
    words = _documents(docs).select("_doc", F.concat(F.array(F.lit("")), words_of(F.col("text"))).alias("words"))
    return words.select("_doc", "words", F.posexplode_outer("words").alias("pos", "word")).withColumn("key", F.lower("word"))


def _found(occurrences: DataFrame, terms: DataFrame) -> DataFrame:
    """The occurrences of ``terms`` (a column ``key`` and others), met through a 64-bit hash and then compared."""
    hashed = terms.withColumn("_h", F.xxhash64("key")).withColumnRenamed("key", "_term")
    met = occurrences.withColumn("_h", F.xxhash64("key")).join(hashed, "_h")
    return met.where("key = _term").drop("_h", "_term")


def _windows(items: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Distinct places of the two rarest words of each window: ``item, words, first, second``.

    Words are looked up by their Unicode lower case, a superset of the equality that counts, so
    that the whole corpus need not be lower-cased letter by letter. A window of one word has the same
    word twice. Windows with a word that no document has cannot occur and are left out.
    """
    n = F.size("words")
    windows = items.select(
        "item", "words", F.explode(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).alias("start")
    ).withColumn("len", F.least(F.size("words"), F.lit(size)))
    placed = windows.select(
        "item", "start", "len", F.posexplode(F.slice("words", F.col("start") + 1, F.col("len"))).alias("off", "word")
    ).select("item", "start", "len", (F.col("start") + F.col("off")).alias("at"), F.lower("word").alias("key"))
    rare = (
        placed.join(counts, "key")
        .groupBy("item", "start")
        .agg(
            F.array_sort(F.collect_list(F.struct("n", "at", "key"))).alias("lists"),  # a window's words, ten at most
            F.first("len").alias("len"),
        )
        .where(F.size("lists") == F.col("len"))
        .select(
            "item",
            F.element_at("lists", 1).alias("a"),
            F.element_at("lists", F.least(F.size("lists"), F.lit(2))).alias("b"),
        )
    )
    return (
        rare.select("item", F.col("a.at").alias("first"), F.col("a.key").alias("first_key"), F.col("b.at").alias("second"), F.col("b.key").alias("second_key"))
        .distinct()
        .join(items.select("item", "words"), "item")
    )


def _around(words: Column, at: Column, size: int) -> tuple[Column, Column]:
    """The word at ``at`` (from 0) and those after it; those before it, nearest first."""
    after = F.slice(words, at + 1, size)
    before = F.reverse(F.slice(words, F.greatest(at - (size - 2), F.lit(1)), F.least(at, F.lit(size - 1))))
    return after, before


def _equal_run(a: Column, b: Column) -> Column:
    """How many leading words two lists share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(same))


def _index(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The windows to look up, and the stored postings of their rarest words."""
    items = materialise(_items(benchmark), "items")
    vocabulary = materialise(
        items.select(F.explode("words").alias("word")).select(F.lower("word").alias("key")).distinct(), "vocabulary"
    )
    counts = materialise(_found(_occurrences(docs).select("key"), vocabulary).groupBy("key").agg(F.count("*").alias("n")), "counts")
    windows = materialise(_windows(items, counts, size), "windows")
    needed = (
        windows.select(F.col("first_key").alias("key"), F.lit(1).alias("leads"))
        .unionByName(windows.select(F.col("second_key").alias("key"), F.lit(0).alias("leads")))
        .unionByName(docs.sparkSession.sql("SELECT '' AS key, 0 AS leads"))
        .groupBy("key")
        .agg(F.max("leads").alias("leads"))
    )
    after, before = _around(F.col("words"), F.col("pos"), size)
    places = _occurrences(docs).select(
        "_doc", "pos", "key", after.alias("after"), before.alias("before"), (F.size("words") - 1).cast("long").alias("n_words")
    )
    found = _found(places, materialise(needed, "needed"))
    leads = F.col("leads") == 1  # only the rarest word of some window needs its surroundings
    postings = materialise(
        found.select(
            "key",
            "_doc",
            (F.col("pos") - 1).alias("pos"),
            F.when(leads, _lowered("after")).alias("after"),
            F.when(leads, _lowered("before")).alias("before"),
            F.when(F.col("key") == "", F.col("n_words")).alias("n_words"),
        ),
        "postings",
    )
    return windows, postings


def _lists(windows: DataFrame, postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists of the rarest and of the second rarest words, each shifted by the word's place in its item."""
    first = postings.join(windows.withColumnRenamed("first_key", "key"), "key").withColumn("shift", F.col("pos") - F.col("first"))
    places = windows.select("item", "first", "second", F.col("second_key").alias("key")).distinct()
    second = (
        postings.select("key", "_doc", "pos")
        .join(places, "key")
        .select("item", "first", "second", "_doc", (F.col("pos") - F.col("second")).alias("shift"))
        .distinct()
    )
    return first, second


def phrase_matches(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``_doc, item_id, start, end``: words ``start:end`` of a document that an item has too.

    Each row is a stretch of ``size`` words or more (at most ``2 * size - 1``; longer passages give
    several rows), or a whole item if the item is shorter. ``_doc`` has ``doc_id`` and ``text_hash``.
    """
    return _matches(*_index(docs, benchmark, size), size)


def _matches(windows: DataFrame, postings: DataFrame, size: int) -> DataFrame:
    first, second = _lists(windows, postings)
    both = first.join(second, ["item", "first", "second", "_doc", "shift"])
    after, before = _around(F.col("words"), F.col("first"), size)
    right, left = _equal_run(F.col("after"), after), _equal_run(F.col("before"), before)
    runs = both.select(
        "_doc", "item.item_id", "pos", F.size("words").alias("len"), right.alias("right"), left.alias("left")
    )
    return (
        runs.where("right > 0")
        .where(F.col("left") + F.col("right") >= F.least(F.col("len"), F.lit(size)))
        .select("_doc", "item_id", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end"))
        .distinct()
    )


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 5, size: int = 10) -> DataFrame:
    """``doc_id, item_id, at``: the two rarest words of a window of the item stand, near ``at``, at most ``slop`` words further
    apart or closer than in the item.

    The lists meet in stretches of ``slop + 1`` shifts, one row for each stretch, so a word that fills a
    document does not meet itself pair by pair.
    """
    windows, postings = _index(docs, benchmark, size)
    first, second = _lists(windows, postings)
    keys = ["item", "first", "second", "_doc"]
    width = slop + 1
    stretch = F.floor(F.col("shift") / width)
    one = first.select(*keys, stretch.alias("stretch"), "shift", "pos").groupBy(*keys, "stretch").agg(
        F.min("shift").alias("low"), F.max("shift").alias("high"), F.min("pos").alias("at")
    )
    # The nearest shift of either list to a stretch boundary decides; a shared stretch always is near enough.
    two = second.select(*keys, stretch.alias("stretch"), "shift").groupBy(*keys, "stretch").agg(
        F.min("shift").alias("low_2"), F.max("shift").alias("high_2")
    )
    moved = two.select(*keys, F.explode(F.array(*[F.struct((F.col("stretch") + d).alias("stretch"), F.lit(d).alias("d")) for d in (-1, 0, 1)])).alias("s"), "low_2", "high_2")
    met = one.join(moved.select(*keys, "s.stretch", "s.d", "low_2", "high_2"), [*keys, "stretch"])
    near = (
        (F.col("d") == 0)
        | ((F.col("d") == -1) & (F.col("low_2") - F.col("high") <= slop))
        | ((F.col("d") == 1) & (F.col("low") - F.col("high_2") <= slop))
    )
    return met.where(near).groupBy("_doc.doc_id", "item.item_id").agg(F.min("at").alias("at"))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """For every row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A null or empty text has no words and no hits; an empty benchmark hits nothing, and an empty
    table of documents gives an empty result. Items without words are skipped; an
    item without id marks words but is not listed. Rows that repeat an id and text get the same
    result each; rows with one id and different texts get their own. Further columns are not read.
    """
    windows, postings = _index(docs, benchmark, size)
    hits = materialise(_matches(windows, postings, size), "hits")
    by_start = Window.partitionBy("_doc").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        hits.select("_doc", "start", "end")
        .distinct()
        .withColumn("from", F.greatest("start", F.coalesce(reach, F.lit(0))))
        .groupBy("_doc")
        .agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    )
    named = hits.groupBy("_doc").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    rows = postings.where("key = ''").select("_doc", "n_words")
    joined = rows.join(covered.join(named, "_doc"), "_doc", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "_doc.doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of the benchmark occurs."""
    hits = materialise(phrase_matches(docs, benchmark, size), "hits")
    leaks = hits.select(F.col("_doc.doc_id").alias("_leak_id"), F.col("_doc.text_hash").alias("_leak_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(leaks["_leak_id"]) & (F.xxhash64(docs["text"]) == leaks["_leak_hash"])
    return docs.join(leaks, same, "left_anti")


_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOW}, '{_PATTERN}') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOW}, '{_PATTERN}') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[s:s + k - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s
        FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT rid, s, k, array_to_string(ws[s:s + k - 1], ' ') AS win
  FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS s
        FROM d CROSS JOIN (SELECT DISTINCT k FROM bw) AS lens WHERE len(ws) >= k)
), hit AS (
  SELECT dw.rid, dw.s, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
