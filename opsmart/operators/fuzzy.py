"""Best fuzzy match per name at a Jaro-Winkler floor, without a cross join.

Two names can only reach the floor if they share enough characters. With ``p``
the length of the common prefix (at most 4), ``m`` the number of characters in
common (counted with repetition), and floor ``t``:

    jaro <= (m/|a| + m/|b| + 1) / 3   and   jaro + 0.1 p (1 - jaro) >= t
    =>  m >= need = (3 J - 1) |a||b| / (|a| + |b|),  J = (t - 0.1p) / (1 - 0.1p)

That is an overlap join on character sets, solved by *prefix filtering*. The
characters of every name are sorted by how rare they are in the data. If two
sorted sets share at least ``n`` members, their two smallest shared members lie
within the first ``size - n + 2`` of each. So a name is indexed under the pairs
among its rarest characters, and candidates meet in a plain equi-join on

    (prefix class, length class of both names, pair of rare characters).

Pairs with a common prefix of three or more are looked for under that prefix
with the weaker bound for p = 4; all others under the bound for p = 2. Length
classes keep the bound tight: each name knows how short a partner may be. A pair
is kept under its first shared key only, so it appears once. The rule is exact:
no pair at or above the floor is lost, whatever the number of partners.

Of the pairs that meet, most are dropped by a signature of 64 bits: members set the
bit of their rank modulo 64, and two names share no more members than bits, plus
the members by which the names outnumber their bits. Only the rest compare sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsmart.functions.similarity import similarity
from opsmart.session import materialise

#: Characters of common prefix that put a pair into the strong class.
HEAD = 3
#: Pairs one task compares under one key before the key is split.
MEETINGS = 10_000_000
STEP = 1.25
_SLACK = 1e-9


def _factor(floor: int, prefix: int) -> float:
    """``3 J - 1`` for a common prefix of this length."""
    share = 0.1 * prefix
    return 3 * (floor / 100 - share) / (1 - share) - 1


def _need(la: Column, lb: Column, factor: float) -> Column:
    """Characters that names of these lengths must share. Grows with either length."""
    la, lb = la.cast("double"), lb.cast("double")
    return F.ceil(F.lit(factor) * la * lb / (la + lb) - F.lit(_SLACK)).cast("int")


def _class_of(length: Column) -> Column:
    """Length class: a quarter longer per class. Never falls as the length grows."""
    return F.floor(F.ln(length.cast("double")) / F.lit(math.log(STEP)) + F.lit(_SLACK)).cast("int")


def _class_start(index: Column) -> Column:
    """No name of this class is shorter."""
    return F.ceil(F.pow(F.lit(STEP), index.cast("double")) * F.lit(1 - _SLACK)).cast("int")


def _with_tags(names: DataFrame) -> DataFrame:
    """Add ``tags``: the characters of ``name`` as sorted ranks, rarest first. The
    n-th occurrence of a character is a member of its own, so the overlap of two
    sets counts repetition. Ranks come from how many names hold the member. ``bits`` is
    the signature of the set."""
    chars = F.split("name", "")
    members = F.transform(
        chars, lambda ch, i: F.concat(ch, F.size(F.filter(F.slice(chars, 1, i + 1), lambda z: z == ch)).cast("string"))
    )
    spread = names.select("name", F.explode(members).alias("member"))
    # one row per character and repetition: as many rows as the alphabet has
    rarity = spread.groupBy("member").agg(F.count(F.lit(1)).alias("n"))
    ranked = rarity.select("member", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("n", "member")).alias("tag"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("tag") % 64)
    tagged = spread.join(ranked, "member").groupBy("name").agg(F.array_sort(F.collect_list("tag")).alias("tags"), F.bit_or(bit).alias("bits"))
    return names.join(tagged, "name")


def _blocks(names: DataFrame, floor: int, role: str) -> DataFrame:
    """One row per name, prefix class and partner length class. ``role`` says
    which side of the pair the name is on."""
    base = names.withColumns({"size": F.size("tags"), "opening": F.substring("name", 1, HEAD)})
    mine, theirs = ("class_l", "class_r") if role == "left" else ("class_r", "class_l")
    parts = []
    for strong, prefix in ((False, HEAD - 1), (True, 4)):
        factor = _factor(floor, prefix)
        side = base.filter(F.col("size") >= HEAD) if strong else base
        size = F.col("size").cast("double")
        shortest = F.greatest(F.ceil((factor - 1) * size - F.lit(_SLACK)), F.lit(1)).cast("int")
        longest = F.floor(size / (factor - 1) + F.lit(_SLACK)).cast("int")
        classes = F.sequence(_class_of(shortest), _class_of(longest))
        parts.append(
            side.withColumn("shortest", shortest).select(
                "name", "tags", "bits", "size", "opening", "shortest",
                F.lit(factor).alias("factor"),
                F.lit(strong).alias("strong"),
                (F.col("opening") if strong else F.lit("")).alias("head"),
                _class_of(F.col("size")).alias(mine),
                F.explode(classes).alias(theirs),
            )
        )
    return parts[0].unionByName(parts[1])


def _index(blocks: DataFrame, role: str) -> DataFrame:
    """One row per block row and index key."""
    mine, theirs = ("class_l", "class_r") if role == "left" else ("class_r", "class_l")
    factor, size = F.col("factor"), F.col("size")
    partner = F.greatest(_class_start(F.col(theirs)), F.col("shortest"))
    # members per key, agreed on by both sides: they both know the two classes
    k = F.least(_need(_class_start(F.col(mine)), _class_start(F.col(theirs)), factor), F.lit(2))
    weakest = F.greatest(_need(size, partner, factor), k)
    rows = blocks.withColumns({"k": k, "rare": F.slice("tags", 1, F.greatest(size - weakest + k, F.lit(0)))})
    pairs = F.flatten(
        F.transform(
            "rare",
            lambda x, i: F.transform(
                F.slice("rare", i + 2, F.size("rare")), lambda y: F.shiftleft(x.cast("bigint"), 32) + y
            ),
        )
    )
    singles = F.transform("rare", lambda x: x.cast("bigint"))
    return rows.select(
        "name", "tags", "bits", "opening", "factor", *_BLOCK, F.explode(F.when(F.col("k") == 2, pairs).otherwise(singles)).alias("token")
    )


_BLOCK = ["strong", "head", "class_l", "class_r"]
_KEY = [*_BLOCK, "token"]


def _split_hot(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut the keys under which more than ``MEETINGS`` pairs meet into tiles. Rows of
    either side are dealt out over its strips and go to all strips of the other side, so
    that a side is copied only as often as the other one is too long for a tile."""
    side = math.isqrt(MEETINGS)
    rows = a.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).join(
        b.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("m")), _KEY, "inner"
    )
    meetings = F.col("n") * F.col("m")
    strips = {s: F.ceil(F.col(n) / side).cast("int").alias(f"strips_{s}") for s, n in (("l", "n"), ("r", "m"))}
    hot = rows.filter(meetings > MEETINGS).select(*_KEY, *strips.values())

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine, theirs = (F.coalesce(f"strips_{s}", F.lit(1)) for s in (own, other))
        df = df.join(hot, _KEY, "left").withColumn(f"tile_{own}", F.pmod(F.xxhash64("name"), mine).cast("int"))
        return df.withColumn(f"tile_{other}", F.explode(F.sequence(F.lit(0), theirs - 1))).drop("strips_l", "strips_r")

    return dealt(a, "l", "r"), dealt(b, "r", "l")


def similar_pairs(left: DataFrame, right: DataFrame, floor: int) -> DataFrame:
    """All pairs ``(name, r_name, similarity)`` of distinct lower-case names at or
    above the floor. Each input has one column, ``name``."""
    if floor <= 80:
        raise ValueError("the shared-character bound needs a floor above 80")
    sides = left.select("name", F.lit(True).alias("l"), F.lit(False).alias("r")).union(
        right.select("name", F.lit(False), F.lit(True))
    )
    names = sides.filter(F.length("name") > 0).groupBy("name").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    # distinct names with their sorted characters: used eight times below
    tagged = materialise(_with_tags(names), "names")
    a, b = _blocks(tagged.filter("l"), floor, "left"), _blocks(tagged.filter("r"), floor, "right")
    # a name unfolds into keys only where the other side has such a block at all
    a_blocks, b_blocks = a.select(_BLOCK).distinct(), b.select(_BLOCK).distinct()
    a, b = _index(a.join(b_blocks, _BLOCK, "left_semi"), "left"), _index(b.join(a_blocks, _BLOCK, "left_semi"), "right")
    # fewer pairs than that in all: no key can be hot
    sizes = tagged.agg(F.count_if("l").alias("l"), F.count_if("r").alias("r")).first()
    keys = _KEY
    if sizes["l"] * sizes["r"] > MEETINGS:
        a, b = _split_hot(a, b)
        keys = [*_KEY, "tile_l", "tile_r"]
    # comparing costs far more than moving these rows: keep all tasks, however few the bytes
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = a.repartition(n, *keys)
    b = b.select(*keys, *[F.col(c).alias(f"r_{c}") for c in ("name", "tags", "bits", "opening")]).repartition(n, *keys)
    met = a.join(b, keys, "inner").filter(
        F.col("strong") | (F.col("opening") != F.col("r_opening")) | (F.length("opening") < HEAD)
    )

    size, r_size = F.size("tags").cast("double"), F.size("r_tags").cast("double")
    need = F.ceil(F.col("factor") * size * r_size / (size + r_size) - F.lit(_SLACK))
    doubled = F.least(F.size("tags") - F.bit_count("bits"), F.size("r_tags") - F.bit_count("r_bits"))
    met = met.filter(F.bit_count(F.col("bits").bitwiseAND(F.col("r_bits"))) + doubled >= need)
    token = F.col("token")

    def first_meeting(shared: Column) -> Column:
        pair = F.shiftleft(F.get(shared, 0).cast("bigint"), 32) + F.get(shared, 1)
        first = F.when(token >= F.lit(1 << 32), pair).otherwise(F.get(shared, 0).cast("bigint"))
        return (F.size(shared) >= need) & (token == first)

    # exists() over a one-element array names the intersection, so it is computed once
    candidates = met.filter(F.exists(F.array(F.array_intersect("tags", "r_tags")), first_meeting)).select("name", "r_name")
    scored = candidates.withColumn("similarity", similarity(F.col("name"), F.col("r_name")))
    return scored.filter(F.col("similarity") >= floor)


def fuzzy_best_match(
    left: DataFrame,
    right: DataFrame,
    left_col: str,
    right_col: str,
    min_sim: int = 85,
    exclude: str | None = None,
    keep_ties: bool = False,
    keep_unmatched: bool = True,
) -> DataFrame:
    """For each distinct name of ``left`` the most similar row(s) of ``right``.

    Result: ``left_col``, the columns of ``right``, ``similarity`` and
    ``row_num`` (1.. among equally similar rows, ordered by all columns of
    ``right``, so the pick is repeatable). ``exclude`` is a LIKE pattern for
    names of ``right`` to leave out. Names without a partner at or above
    ``min_sim`` stay with NULLs unless ``keep_unmatched`` is off.
    """
    lefts = left.select(left_col).filter(F.col(left_col).isNotNull()).distinct().withColumn("_l", F.lower(left_col))
    rights = right.filter(F.col(right_col).isNotNull())
    if exclude:
        rights = rights.filter(~F.col(right_col).like(exclude))
    rights = rights.withColumn("_r", F.lower(right_col))

    found = similar_pairs(
        lefts.select(F.col("_l").alias("name")).distinct(), rights.select(F.col("_r").alias("name")).distinct(), min_sim
    )
    best = Window.partitionBy("name").orderBy(F.desc("similarity"))
    found = found.withColumn("_place", F.rank().over(best)).filter("_place = 1").drop("_place")

    hits = lefts.join(found, F.col("_l") == F.col("name"), "inner").drop("name", "_l")
    hits = hits.join(rights, F.col("r_name") == F.col("_r"), "inner").drop("r_name", "_r")
    order = Window.partitionBy(left_col).orderBy(F.desc("similarity"), *right.columns)
    hits = hits.withColumn("row_num", F.row_number().over(order))
    if not keep_ties:
        hits = hits.filter("row_num = 1")
    hits = hits.select(left_col, *right.columns, "similarity", "row_num")
    if not keep_unmatched:
        return hits
    base = left.select(left_col).distinct()
    return base.join(hits, left_col, "left").withColumn("row_num", F.coalesce("row_num", F.lit(1)))
