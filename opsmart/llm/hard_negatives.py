"""Hard negatives by exact inner product, found in cover trees over norm-augmented vectors.

Vectors are scaled to integers. A vector ``x`` of a tree gets one more component, ``sqrt(M^2 - |x|^2)``
with the tree's greatest norm ``M``, so all lie on one sphere and the angle to a query (whose extra component is
zero) falls as the inner product rises. A node of the tree is a centre, which is one of its vectors, and the points nearest to
it among the centres of its parent; centres are taken farthest first, so centres of one parent stand at least as far apart as the
covering radius that they leave, and the parent's centre is the first of them. By the covering radius of a node (an angle) and
the angle between query and centre, the inner products of all its points lie in an interval.

A search descends best first: the open node with the highest bound comes next, for all queries that still need it. A
node whose interval lies outside a query's window, below the query's k-th best score so far, or whose labels cannot serve it,
is skipped with all below it. Points of a leaf are verified exactly, by whole numbers.

On Spark, the top level of the tree is a bounded number of *pivots*: each vector goes to its nearest pivot, and each pivot's
vectors are cut by a hash into blocks of bounded size, each with a tree of its own, so a pivot with a third of all rows is many
blocks. Anchors first search the blocks of their own pivot, then only those whose ball can hold a better positive, then,
for their negatives, those whose ball meets one of their windows. Trees and anchors of a block meet in a
cogroup whose two sides are both of bounded size; what each block finds is merged by a top-k.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from opsmart.session import materialise

#: Factor by which components are scaled before they are cut to whole numbers.
SCALE = 256
#: Scaled components stay below this, so that products of vectors of up to 4,096 components are exact in a double.
LARGEST = 2.0**20
PIVOTS = 64
BLOCK_ROWS = 8192
ANCHORS_AT_ONCE = 4096
_LEAF = 64
_FANOUT = 16
#: Bounds are worked out in floating point; they are widened by this share of the largest possible product.
_SLACK = 1e-6
_NO_LABEL = np.uint64(0)


# ---- the tree ----------------------------------------------------------------


@dataclass
class CoverTree:
    """Points are ordered so that each node holds ``points[start:end]``; children of a node are neighbours, too."""

    points: np.ndarray  # whole numbers, as doubles
    uid: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    top: np.ndarray  # the greatest norm of the tree, one value
    centre: np.ndarray  # position of a node's centre
    start: np.ndarray
    end: np.ndarray
    cos: np.ndarray  # cosine of the covering radius
    norm: np.ndarray  # greatest norm in the node
    labels: np.ndarray  # 64-bit mask of the labels in the node
    child: np.ndarray  # first child
    children: np.ndarray  # number of children, none in a leaf

    def to_bytes(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f.name)).tobytes() for f in fields(self)]

    @staticmethod
    def from_bytes(parts: list[bytes], width: int) -> "CoverTree":
        kinds = ["<f8", "<i8", "<i8", "<i8", "<f8", "<i8", "<i8", "<i8", "<f8", "<f8", "<u8", "<i8", "<i8"]
        arrays = [np.frombuffer(b, k) for b, k in zip(parts, kinds, strict=True)]
        return CoverTree(arrays[0].reshape(len(arrays[1]), width), *arrays[1:])


def _mask(labels: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (labels.astype(np.int64) % 64).astype(np.uint64)


def _augmented(points: np.ndarray, top: float) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)
    return np.concatenate([points, np.sqrt(np.maximum(top * top - squares, 0))[:, None]], axis=1)


def build(points: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, leaf: int = _LEAF, fanout: int = _FANOUT) -> CoverTree:
    """A tree over these points (at least one); equal points cannot be told apart and share a leaf, however many they are."""
    norms = np.sqrt(np.einsum("ij,ij->i", points, points))
    top = float(norms.max())
    sphere = _augmented(points, top) / (top or 1.0)
    order = np.arange(len(points))
    columns: dict[str, list] = {c: [] for c in ("centre", "start", "end", "cos", "norm", "labels", "child", "children")}

    def node(centre: int, start: int, end: int) -> int:
        mine = order[start:end]
        columns["centre"].append(centre)
        columns["start"].append(start)
        columns["end"].append(end)
        columns["cos"].append(float((sphere[mine] @ sphere[centre]).min()) if top else 1.0)
        columns["norm"].append(float(norms[mine].max()))
        columns["labels"].append(np.bitwise_or.reduce(_mask(label[mine])))
        columns["child"].append(0)
        columns["children"].append(0)
        return len(columns["centre"]) - 1

    waiting = [node(0, 0, len(points))]
    while waiting:
        k = waiting.pop()
        start, end = columns["start"][k], columns["end"][k]
        if end - start <= leaf or columns["cos"][k] >= 1 - 1e-12:
            continue
        mine = order[start:end]
        centres, near = [columns["centre"][k]], sphere[mine] @ sphere[columns["centre"][k]]
        home = np.zeros(len(mine), np.int64)
        near[mine == centres[0]] = 2.0  # a centre belongs to itself
        while len(centres) < fanout:
            far = int(near.argmin())
            if near[far] >= 1 - 1e-12:
                break
            other = sphere[mine] @ sphere[mine[far]]
            other[far] = 2.0
            closer = other > near
            home[closer], near = len(centres), np.maximum(near, other)
            centres.append(int(mine[far]))
        if len(centres) == 1:
            continue
        by_home = np.argsort(home, kind="stable")
        order[start:end] = mine[by_home]
        cuts = start + np.concatenate([[0], np.cumsum(np.bincount(home, minlength=len(centres)))])
        columns["child"][k] = len(columns["centre"])
        columns["children"][k] = len(centres)
        waiting += [node(c, int(cuts[i]), int(cuts[i + 1])) for i, c in enumerate(centres)]
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    kinds = {"cos": "<f8", "norm": "<f8", "labels": "<u8"}
    arrays = {c: np.array(v, kinds.get(c, "<i8")) for c, v in columns.items()}
    arrays["centre"] = place[arrays["centre"]]
    return CoverTree(points[order], uid[order], vec_id[order], label[order], np.array([top]), **arrays)


@dataclass
class Queries:
    """Each asks for the ``k`` best points of its anchor with scores from ``low`` to ``high``; label and anchor itself as told."""

    anchor: np.ndarray  # row of the anchor matrix
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray  # scores below cannot be among the best, by what is known already


class Found:
    """The best ``k`` of each query: higher scores first, equal scores by smaller id."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), -np.inf)
        self.vec_id = np.full((queries, k), np.iinfo(np.int64).max)
        self.uid = np.full((queries, k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        """``score`` has a row for each of ``rows`` and a column for each point; minus infinity is no candidate."""
        k = self.score.shape[1]
        scores = np.concatenate([self.score[rows], score], axis=1)
        ids = np.concatenate([self.vec_id[rows], np.broadcast_to(vec_id, score.shape)], axis=1)
        uids = np.concatenate([self.uid[rows], np.broadcast_to(uid, score.shape)], axis=1)
        best = np.lexsort((uids, ids, -scores), axis=1)[:, :k]
        for name, values in (("score", scores), ("vec_id", ids), ("uid", uids)):
            getattr(self, name)[rows] = np.take_along_axis(values, best, axis=1)


def search(tree: CoverTree, vectors: np.ndarray, uid: np.ndarray, label: np.ndarray, q: Queries, k: int, same_label: bool) -> Found:
    """The ``k`` best points of ``tree`` for each query, exactly; see the module's docstring for what is skipped."""
    found = Found(len(q.anchor), k)
    top = float(tree.top[0])
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    reach = lengths * top
    inverse = np.divide(1.0, reach, out=np.zeros_like(reach), where=reach > 0)
    own = _mask(label)

    def wanted(node: int, rows: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Which of these queries may find something in the node."""
        if same_label:
            fits = (own[q.anchor[rows]] & tree.labels[node]) != _NO_LABEL
        else:  # one bit stands for several labels, so no mask rules out another label
            fits = np.ones(len(rows), bool)
        need = np.maximum(np.maximum(found.score[rows, -1], q.floor[rows]), q.low[rows])
        return fits & (upper >= need) & (lower <= q.high[rows])

    def bounds(node: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = q.anchor[rows]
        cos = np.clip((vectors @ tree.points[tree.centre[node]])[a] * inverse[a], -1.0, 1.0)
        wide = min(max(float(tree.cos[node]), -1.0), 1.0)
        even, odd = cos * wide, np.sqrt((1 - cos * cos) * (1 - wide * wide))
        upper = np.where(cos >= wide, 1.0, even + odd) * reach[a]
        lower = np.where(cos <= -wide, -1.0, even - odd) * reach[a]
        cap, slack = lengths[a] * float(tree.norm[node]), _SLACK * reach[a] + _SLACK
        return np.minimum(upper, cap) + slack, np.maximum(lower, -cap) - slack

    if not len(q.anchor):
        return found
    rows = np.arange(len(q.anchor))
    upper, lower = bounds(0, rows)
    heap = [(-float(upper.max()), 0, rows, upper, lower)]
    while heap:
        _, node, rows, upper, lower = heapq.heappop(heap)
        keep = wanted(node, rows, upper, lower)
        rows = rows[keep]
        if not len(rows):
            continue
        if tree.children[node]:
            for child in range(tree.child[node], tree.child[node] + tree.children[node]):
                upper, lower = bounds(child, rows)
                keep = wanted(child, rows, upper, lower)
                if keep.any():
                    heapq.heappush(heap, (-float(upper[keep].max()), int(child), rows[keep], upper[keep], lower[keep]))
            continue
        mine = slice(int(tree.start[node]), int(tree.end[node]))
        anchors, back = np.unique(q.anchor[rows], return_inverse=True)
        exact = vectors[anchors] @ tree.points[mine].T
        good = (label[anchors][:, None] == tree.label[mine]) == same_label
        good &= uid[anchors][:, None] != tree.uid[mine]
        score, good = exact[back], good[back]
        need = np.maximum(np.maximum(found.score[rows, -1], q.floor[rows]), q.low[rows])
        good &= (score >= need[:, None]) & (score <= q.high[rows][:, None])
        some = good.any(axis=1)
        if some.any():
            found.offer(rows[some], np.where(good[some], score[some], -np.inf), tree.vec_id[mine], tree.uid[mine])
    return found


# ---- on Spark ----------------------------------------------------------------

_TREE = [f.name for f in fields(CoverTree)]
_PAYLOAD = "array<double>"


def _prepared(embeddings: DataFrame) -> DataFrame:
    """``uid, vec_id, label, q``: rows that take part, once each, with whole-numbered components as doubles."""
    x = F.col("embedding")
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    )
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    whole = F.transform(x.cast(_PAYLOAD), lambda v: F.floor(v * F.lit(float(SCALE))).cast("double"))
    checked = F.when(
        F.exists(x.cast(_PAYLOAD), lambda v: F.abs(v) * SCALE >= LARGEST),
        F.raise_error(F.lit("a component is too large for exact products")).cast(_PAYLOAD),
    ).otherwise(whole)
    rows = embeddings.where(usable).select(F.col("vec_id").cast("long"), moved.alias("label"), checked.alias("q"))
    return rows.dropDuplicates(["vec_id", "label", "q"]).select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", "q")


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of doubles as rows; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    if len(column) and (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    ends = np.cumsum(sizes)
    for k, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
        out[k, : b - a] = flat[a:b]
    return out


def _plain(column: pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    return column.to_numpy().astype(kind, copy=False)


def _with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with their nearest pivot, their distance to it and their norm."""
    width = pivots.shape[1]
    squares = np.einsum("ij,ij->i", pivots, pivots)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("q"), width)
            pivot = (squares - 2 * (x @ pivots.T)).argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            off = np.sqrt(((x - pivots[pivot]) ** 2).sum(axis=1))
            norm = np.sqrt((x * x).sum(axis=1))
            extra = [pa.array(pivot.astype(np.int32)), pa.array(off), pa.array(norm)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "pivot", "off", "norm"])

    return rows.mapInArrow(run, "uid long, vec_id long, label long, q array<double>, pivot int, off double, norm double")


def _trees(rows: DataFrame, width: int) -> DataFrame:
    """One row for each block: its tree, as binary columns."""

    def grow(table: pa.Table) -> pa.Table:
        tree = build(
            _matrix(table["q"], width), *(_plain(table[c]) for c in ("uid", "vec_id", "label"))
        )
        keys = {c: pa.array([table[c][0].as_py()], pa.int32()) for c in ("pivot", "block")}
        return pa.table(keys | {n: pa.array([b], pa.binary()) for n, b in zip(_TREE, tree.to_bytes(), strict=True)})

    kept = rows.select("pivot", "block", "uid", "vec_id", "label", "q")
    return kept.groupBy("pivot", "block").applyInArrow(grow, "pivot int, block int, " + ", ".join(f"{n} binary" for n in _TREE))


@dataclass(frozen=True)
class _Ball:
    """All vectors of a pivot: its centre, the distance of the farthest one, the greatest norm, and the blocks."""

    pivot: int
    radius: float
    norm: float
    blocks: int


def _routed(anchors: DataFrame, pivots: np.ndarray, balls: list[_Ball], mode: str) -> DataFrame:
    """Anchors with the pivots that they have to look into, exploded over the blocks of these.

    ``home``: their own pivot. ``rest``: others whose ball can hold a score of ``floor`` or more. ``windows``: those whose ball
    meets one of ``windows``.
    """
    width = pivots.shape[1]
    at = np.array([b.pivot for b in balls])
    centres, radius, most = pivots[at], np.array([b.radius for b in balls]), np.array([b.norm for b in balls])

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("q"), width)
            length = np.sqrt((x * x).sum(axis=1))[:, None]
            middle, cap = x @ centres.T, length * most
            slack = _SLACK * (length * (most + radius)) + _SLACK
            upper, lower = np.minimum(middle + length * radius, cap) + slack, np.maximum(middle - length * radius, -cap) - slack
            home = batch.column("pivot").to_numpy()[:, None] == at
            if mode == "home":
                open_ = home
            elif mode == "rest":
                open_ = ~home & (upper >= batch.column("floor").to_numpy(zero_copy_only=False)[:, None])
            else:
                open_ = np.zeros(upper.shape, bool)
                for i, ws in enumerate(batch.column("windows").to_pylist()):
                    for w in ws:
                        open_[i] |= (upper[i] >= w["low"]) & (lower[i] <= w["high"])
            targets = pa.array([at[o].tolist() for o in open_], pa.list_(pa.int32()))
            names = [*batch.schema.names, "targets"]
            yield pa.RecordBatch.from_arrays([*batch.columns, targets], names=names)

    schema = StructType([*anchors.schema.fields, StructField("targets", ArrayType(IntegerType()))])
    blocks = F.element_at(F.create_map(*[F.lit(v) for b in balls for v in (b.pivot, b.blocks)]), F.col("target"))
    return (
        anchors.mapInArrow(run, schema)
        .withColumn("target", F.explode("targets"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .drop("targets", "pivot")
        .withColumnRenamed("target", "pivot")
    )


def _searched(routed: DataFrame, trees: DataFrame, width: int, parts: int, k: int, same_label: bool) -> DataFrame:
    """``anchor_uid, window, vec_id, uid, score``: what each block finds for the anchors that look into it.

    Anchors are cut by a hash into ``parts``, and a block's tree is copied to each part that has anchors for it,
    so one group holds a tree and a bounded number of anchors.
    """
    left = routed.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    right = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor_uid", "window", "vec_id", "uid", "score")}
        if anchors.num_rows and block.num_rows:
            tree = CoverTree.from_bytes([block[n][0].as_py() for n in _TREE], width)
            uid, windows = _plain(anchors["uid"]), anchors["windows"].to_pylist()
            rows = [(i, w["window"], w["low"], w["high"]) for i, ws in enumerate(windows) for w in ws]
            q = Queries(
                np.array([r[0] for r in rows], np.int64), np.array([r[2] for r in rows]), np.array([r[3] for r in rows]),
                np.repeat(_plain(anchors["floor"], np.float64), [len(w) for w in windows]),
            )
            got = search(tree, _matrix(anchors["q"], width), uid, _plain(anchors["label"]), q, k, same_label)
            hit, rank = np.nonzero(got.score > -np.inf)
            out["anchor_uid"] = uid[q.anchor[hit]]
            out["window"] = np.array([r[1] for r in rows], np.int32)[hit]
            out["vec_id"], out["uid"] = got.vec_id[hit, rank], got.uid[hit, rank]
            out["score"] = got.score[hit, rank].astype(np.int64)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds, strict=True)})

    keys = ["pivot", "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "anchor_uid long, window int, vec_id long, uid long, score long"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and window, with their rank."""
    order = Window.partitionBy("anchor_uid", "window").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_window(low: Column, high: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("window"), low.alias("low"), high.alias("high")))


def hard_negatives(
    embeddings: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
    anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose id is divisible by ``every``; positives their best rows of the same label, negatives
    the best rows of other labels with 50 to 95 hundredths of the positive's score. Rows without id, label or vector, or with
    a null or non-finite component, take no part; rows equal in id, label and vector count once, and rows that share an id only are rows of their own (of
    equal scores the smaller id comes first). Shorter vectors count as filled up with zeros. A component of 4,096 or more is an error, as products
    would not be exact. An empty table, or one without anchors, gives an empty result. Other columns are not read.
    """
    spark = embeddings.sparkSession
    empty = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    rows = materialise(_prepared(embeddings), "vectors")
    head = rows.agg(F.max(F.size("q")), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    if not head[1]:
        return empty
    width, parts = head[0], -(-head[1] // anchors_at_once)
    chosen = rows.orderBy(F.xxhash64("vec_id"), "uid").limit(pivots).select("q").collect()
    points = np.array([[*r["q"], *[0.0] * (width - len(r["q"]))] for r in chosen]).reshape(len(chosen), width)
    dealt = materialise(_with_pivots(rows, points), "pivots")
    sizes = dealt.groupBy("pivot").agg(F.max("off").alias("r"), F.max("norm").alias("m"), F.count("*").alias("n")).collect()
    balls = [_Ball(r["pivot"], r["r"], r["m"], -(-r["n"] // block_rows)) for r in sizes]
    blocks = F.element_at(F.create_map(*[F.lit(v) for b in balls for v in (b.pivot, b.blocks)]), F.col("pivot"))
    trees = materialise(_trees(dealt.withColumn("block", F.pmod(F.xxhash64("uid"), blocks).cast("int")), width), "trees")

    anchors = dealt.where(F.col("vec_id") % every == 0).select("uid", "vec_id", "label", "q", "pivot")
    nothing, all_ = F.lit(float("-inf")), _one_window(F.lit(float("-inf")), F.lit(float("inf")))
    asked = anchors.withColumn("floor", nothing).withColumn("windows", all_)

    def positives_of(some: DataFrame, mode: str) -> DataFrame:
        routed = _routed(some, points, balls, mode)
        return _searched(routed, trees, width, parts, positives, same_label=True)

    home = materialise(_best(positives_of(asked, "home"), positives).drop("rank"), "home")
    floors = home.groupBy("anchor_uid").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = floors.where(F.col("n") >= positives).select(F.col("anchor_uid").alias("uid"), F.col("least").cast("double").alias("least"))
    further = asked.join(floors, "uid", "left").withColumn("floor", F.coalesce("least", nothing)).drop("least")
    both = home.unionByName(positives_of(further.select(asked.columns), "rest"))
    chosen_positives = materialise(
        _best(both, positives).select("anchor_uid", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    s = F.col("positive_score")
    window = F.struct(
        "window",
        F.expr("(50 * positive_score + 99) div 100").cast("double").alias("low"),
        F.expr("(95 * positive_score) div 100").cast("double").alias("high"),
    )
    windows = chosen_positives.where(s >= 0).groupBy(F.col("anchor_uid").alias("uid")).agg(F.collect_list(window).alias("windows"))
    asked = anchors.join(windows, "uid").withColumn("floor", nothing)
    found = _searched(_routed(asked, points, balls, "windows"), trees, width, parts, negatives, same_label=False)
    best = _best(found, negatives).select(
        "anchor_uid", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = anchors.select(F.col("uid").alias("anchor_uid"), F.col("vec_id").alias("anchor_id"))
    return (
        best.join(chosen_positives, ["anchor_uid", "window"])
        .join(named, "anchor_uid")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


SQL = """
with r as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as (
    select a.vec_id as anchor_id, a.label, a.q, b.vec_id as positive_id, list_dot_product(a.q, b.q)::bigint as positive_score
    from r a join r b on a.label = b.label and a.vec_id <> b.vec_id where a.vec_id % 50 = 0
    qualify row_number() over (partition by a.vec_id order by list_dot_product(a.q, b.q) desc, b.vec_id) <= 5),
n as (
    select anchor_id, positive_id, positive_score, r.vec_id as negative_id, list_dot_product(p.q, r.q)::bigint as negative_score
    from p join r on r.label <> p.label)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id)::int as rank,
    negative_id, positive_score, negative_score
from n where 50 * positive_score <= 100 * negative_score and 100 * negative_score <= 95 * positive_score
qualify rank <= 3
"""
