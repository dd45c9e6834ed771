"""Hard-negative mining: inner-product windows over cover trees of norm-augmented vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, ship

ship(__name__)

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies within these hundredths of its positive's.
LOW, HIGH = 50, 95
#: A tree covers at most so many rows; every row is in one.  Anchors meet trees in blocks of so many.
TREE_ROWS, BLOCK_ROWS = 4096, 256
#: A node splits until its rows fit a leaf; its children are a net of at most FAN centers, finer by BASE where FAN allows.
LEAF_ROWS, FAN, BASE = 256, 16, 1.3
#: Angles are known to about so much (arc cosine near 1); vectors closer than that share a leaf.
ANGLE_SLACK = 1e-7
#: Keys of results: score, then row, in one 64-bit integer while scores stay below LIMIT.
SPAN, LIMIT = 1 << 13, 1 << 49
#: The key of no row, below all others; the second for whole numbers of any size.
NOTHING, LEAST = -(1 << 62), -(1 << 140)

TREE = pa.schema([
    ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("order", pa.list_(pa.int32())), ("vectors", pa.binary()),
    ("kind", pa.string()), ("width", pa.int32()), ("center", pa.list_(pa.int32())), ("radius", pa.list_(pa.float64())),
    ("child", pa.list_(pa.int32())), ("children", pa.list_(pa.int32())), ("start", pa.list_(pa.int32())), ("stop", pa.list_(pa.int32()))])
TREE_TYPE = ("ids array<long>, labels array<long>, `order` array<int>, vectors binary, kind string, width int, center array<int>, "
             "radius array<double>, child array<int>, children array<int>, start array<int>, stop array<int>")
BLOCK = pa.schema([("b_ids", pa.list_(pa.int64())), ("b_labels", pa.list_(pa.int64())), ("b_vectors", pa.binary()),
                   ("b_kind", pa.string()), ("b_width", pa.int32())])
BLOCK_TYPE = "b_ids array<long>, b_labels array<long>, b_vectors binary, b_kind string, b_width int"


# --- vectors

def scaled(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the rows that take part: their places in the batch, labels, and vectors of floor(scale * x)."""
    labels, lists = batch.column("label"), batch.column("vector")
    places, kept, vectors = [], [], []
    flat = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    whole = np.isfinite(flat)
    flat = np.floor(np.where(whole, flat, 0) * scale)
    ends = np.cumsum(lengths)
    usable = labels.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(usable):
        a, b = ends[i] - lengths[i], ends[i]
        if whole[a:b].all():
            places.append(i)
            kept.append(labels[int(i)].as_py())
            vectors.append(flat[a:b])
    return np.array(places, dtype=np.int64), np.array(kept, dtype=np.int64), vectors


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of one width; a shorter vector goes on with zeros."""
    width = max((len(v) for v in vectors), default=0)
    if all(len(v) == width for v in vectors):
        return np.array(vectors, dtype=np.float64).reshape(len(vectors), width)
    return np.array([np.pad(v, (0, width - len(v))) for v in vectors], dtype=np.float64)


def packed(x: np.ndarray) -> tuple[bytes, str, int]:
    """The matrix in the shortest type that holds it exactly."""
    most = np.abs(x).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return x.astype(kind).tobytes(), kind, x.shape[1]


def unpacked(data: bytes, kind: str, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).astype(np.float64).reshape(rows, width)


def fit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products stay below LIMIT."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(min(a.shape[1], b.shape[1]), 1) < LIMIT


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, rows of a by rows of b: doubles while all sums fit, else Python's integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if fit(a, b):
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return whole(a).dot(whole(b).T)


# --- trees

@dataclass
class Tree:
    """A cover tree in arrays.

    Rows are numbered by ascending id; ``order`` and ``labels`` and ``vectors`` run in leaf order.  Node ``i`` has the row
    ``center[i]`` (a place in leaf order), an angle ``radius[i]`` around it that holds all its rows once norms are made
    equal, and either ``children[i]`` nodes from ``child[i]`` or, if 0, the rows from ``start[i]`` to ``stop[i]``.
    """

    ids: np.ndarray
    labels: np.ndarray
    order: np.ndarray
    vectors: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    def __post_init__(self):
        norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.norm = float(norms.max(initial=0))
        # Whether all rows of a node share a label.
        self.same = np.array([(self.labels[a:b] == self.labels[a]).all() for a, b in zip(self.start, self.stop, strict=True)], dtype=bool)


def augmented(x: np.ndarray) -> np.ndarray:
    """Unit vectors with one more component that makes up for shorter norms: inner products with a query (whose
    further component is 0) fall with the angle."""
    squares = (x ** 2).sum(axis=1)
    most = squares.max(initial=0)
    if not most:
        return np.hstack([x, np.ones((len(x), 1))])
    return np.hstack([x, np.sqrt(np.maximum(most - squares, 0))[:, None]]) / np.sqrt(most)


def angles(y: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(y @ center, -1, 1))


def plant(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> Tree:
    """A tree over rows sorted by id (rows without id last and not in ``ids``)."""
    y = augmented(x)
    nodes: list[dict] = [{"rows": np.arange(len(x)), "center": 0}]
    nodes[0]["radius"] = float(angles(y, y[0]).max()) + ANGLE_SLACK
    at = 0
    while at < len(nodes):
        node, rows = nodes[at], nodes[at]["rows"]
        node["child"], node["children"] = 0, 0
        if len(rows) > LEAF_ROWS and node["radius"] > 3 * ANGLE_SLACK:
            node["child"], net = len(nodes), split(y, rows, node["center"], node["radius"])
            node["children"] = len(net)
            nodes += net
        at += 1
    # Leaf order: children one after another, so that every node is a range.
    order: list[np.ndarray] = []
    filled = 0
    stack = [0]
    while stack:
        i = stack.pop()
        if i < 0:
            nodes[~i]["stop"] = filled
            continue
        nodes[i]["start"] = filled
        if nodes[i]["children"]:
            stack += [~i, *range(nodes[i]["child"], nodes[i]["child"] + nodes[i]["children"])]
        else:
            order.append(np.sort(nodes[i]["rows"]))
            filled += len(nodes[i]["rows"])
            nodes[i]["stop"] = filled
    placed = np.concatenate(order)
    where = np.empty(len(placed), dtype=np.int64)
    where[placed] = np.arange(len(placed))
    column = lambda name: np.array([n[name] for n in nodes])
    return Tree(ids, labels[placed], placed, x[placed], where[column("center")], column("radius"), column("child"),
                column("children"), column("start"), column("stop"))


def split(y: np.ndarray, rows: np.ndarray, center: int, radius: float) -> list[dict]:
    """Children of a node: centers taken farthest first, each row with its nearest, and the angles that cover them."""
    own = y[rows]
    centers, nearest = [center], angles(own, y[center])
    owner = np.zeros(len(rows), dtype=np.int64)
    while len(centers) < FAN:
        far = int(nearest.argmax())
        if nearest[far] <= max(radius / BASE, ANGLE_SLACK) and len(centers) > 1:
            break
        angle = angles(own, own[far])
        closer = angle < nearest
        closer[far] = True
        owner[closer] = len(centers)
        nearest = np.minimum(nearest, angle)
        centers.append(int(rows[far]))
    parts = [(c, owner == k) for k, c in enumerate(centers)]
    return [{"rows": rows[m], "center": c, "radius": float(nearest[m].max()) + ANGLE_SLACK} for c, m in parts if m.any()]


def best(tree: Tree, q: np.ndarray, labels: np.ndarray, own: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
         alike: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window, the keys of its first k rows (windows x k), and which of them there are.

    Window ``w`` belongs to query ``of[w]`` and admits scores from ``low[w]`` to ``high[w]`` of rows whose label is the
    query's (``alike``) or another one.  ``own`` are the queries' ids; rows of that id are no partners of their own label.

    Descent is best first for the block: the node that is the best open one for most windows is opened next, for all windows
    that it may still serve.  A node is outside a window if its bounds miss it, or its upper bound lies strictly below the kth score.
    """
    size = np.sqrt((q ** 2).sum(axis=1))
    short = fit(q, tree.vectors)
    kind, none = (np.int64, NOTHING) if short else (object, LEAST)
    found = np.full((len(of), k), none, dtype=kind)
    if not len(of) or not len(tree.vectors):
        return found, found != none
    reach = size * tree.norm
    slack = 1e-6 * reach + 1
    y_center = augmented(np.vstack([tree.vectors[tree.center], tree.vectors[np.argmax((tree.vectors ** 2).sum(axis=1))][None]]))[:-1, :-1]
    unit = q / np.where(size > 0, size, 1)[:, None]
    width = min(unit.shape[1], y_center.shape[1])
    lows, highs = low.astype(np.float64), high.astype(np.float64)
    left, right = np.searchsorted(tree.ids, own, "left"), np.searchsorted(tree.ids, own, "right")

    def promise(nodes: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """The best score that each node may hold inside each window; minus infinity if it is outside."""
        asked, back = np.unique(of[windows], return_inverse=True)
        theta = np.arccos(np.clip(y_center[nodes, :width] @ unit[asked, :width].T, -1, 1))
        most = reach[asked] * np.cos(np.maximum(theta - tree.radius[nodes][:, None], 0)) + slack[asked]
        least = reach[asked] * np.cos(np.minimum(theta + tree.radius[nodes][:, None], np.pi)) - slack[asked]
        shared = tree.labels[tree.start[nodes]][:, None] == labels[asked][None, :]
        wrong = tree.same[nodes][:, None] & (~shared if alike else shared)
        most = np.where(wrong, -np.inf, most)[:, back]
        least = least[:, back]
        top = np.minimum(most, highs[windows])
        return np.where((least > highs[windows]) | (most < lows[windows]), -np.inf, top)

    floor = np.full(len(of), -np.inf)
    opened = np.full((len(tree.center), len(of)), -np.inf)
    opened[0] = promise(np.array([0]), np.arange(len(of)))[0]
    while True:
        first = opened.argmax(axis=0)
        value = opened[first, np.arange(len(of))]
        active = (value >= floor) & (value > -np.inf)
        if not active.any():
            return found, found != none
        node = int(np.bincount(first[active]).argmax())
        windows = np.flatnonzero((opened[node] >= floor) & (opened[node] > -np.inf))
        opened[node] = -np.inf
        if tree.children[node]:
            below = np.arange(tree.child[node], tree.child[node] + tree.children[node])
            opened[below[:, None], windows] = promise(below, windows)
            continue
        a, b = tree.start[node], tree.stop[node]
        asked, back = np.unique(of[windows], return_inverse=True)
        score = products(q[asked], tree.vectors[a:b])
        rows = tree.order[a:b]
        alive = (tree.labels[a:b][None, :] == labels[asked][:, None])
        if alike:
            alive &= (rows[None, :] < left[asked][:, None]) | (rows[None, :] >= right[asked][:, None])
        else:
            alive = ~alive
        score, alive = score[back], alive[back]
        alive &= (score >= low[windows][:, None]) & (score <= high[windows][:, None])
        keys = np.where(alive, score.astype(kind) * SPAN + (SPAN - 1 - rows.astype(kind))[None, :], none)
        merged = np.concatenate([found[windows], keys], axis=1)
        merged = np.partition(merged, merged.shape[1] - k, axis=1) if short else np.sort(merged, axis=1)
        found[windows] = merged[:, -k:]
        worst = found[windows].min(axis=1)
        floor[windows] = np.where(worst > none, (worst // SPAN).astype(np.float64), -np.inf)


# --- tasks

def make_trees(scale: int):
    def run(batches):
        ids, labels, vectors = [], [], []

        def tree():
            sort = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, labels[i], vectors[i].tobytes()))
            known = [ids[i] for i in sort if ids[i] is not None]
            t = plant(np.array(known, dtype=np.int64), np.array([labels[i] for i in sort], dtype=np.int64), matrix([vectors[i] for i in sort]))
            data, kind, width = packed(t.vectors)
            row = [known, t.labels.tolist(), t.order.tolist(), data, kind, width, t.center.tolist(), t.radius.tolist(),
                   t.child.tolist(), t.children.tolist(), t.start.tolist(), t.stop.tolist()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, TREE, strict=True)], schema=TREE)

        for batch in batches:
            places, own, rows = scaled(batch, scale)
            keys = batch.column("id").to_pylist()
            for place, label, vector in zip(places, own, rows, strict=True):
                ids.append(keys[place])
                labels.append(label)
                vectors.append(vector)
                if len(ids) == TREE_ROWS:
                    yield tree()
                    ids, labels, vectors = [], [], []
        if ids:
            yield tree()

    return run


def make_blocks(scale: int):
    def run(batches):
        for batch in batches:
            places, labels, vectors = scaled(batch, scale)
            ids = batch.column("id").to_pylist()
            for a in range(0, len(places), BLOCK_ROWS):
                data, kind, width = packed(matrix(vectors[a:a + BLOCK_ROWS]))
                row = [[ids[p] for p in places[a:a + BLOCK_ROWS]], labels[a:a + BLOCK_ROWS], data, kind, width]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK, strict=True)], schema=BLOCK)

    return run


def pairs_of(batches):
    """(tree, anchors' ids, labels and vectors, the row) of each pair; a tree is unpacked once for the pairs that follow each other."""
    last, tree = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            if row["tree"].as_py() != last:
                last = row["tree"].as_py()
                arrays = {n: row[n].values.to_numpy() for n in ("ids", "labels", "order", "center", "radius", "child", "children", "start", "stop")}
                tree = Tree(vectors=unpacked(row["vectors"].as_py(), row["kind"].as_py(), row["width"].as_py(), len(arrays["labels"])), **arrays)
            ids = row["b_ids"].values.to_numpy()
            vectors = unpacked(row["b_vectors"].as_py(), row["b_kind"].as_py(), row["b_width"].as_py(), len(ids))
            yield tree, ids, row["b_labels"].values.to_numpy(), vectors, row


NEAR = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
NEAR_TYPE = "block long, at int, vec_id long, score long"


def keys_apart(tree: Tree, keys: np.ndarray) -> tuple[list, list]:
    scores = [int(key) // SPAN for key in keys]
    rows = [SPAN - 1 - int(key) % SPAN for key in keys]
    return scores, [int(tree.ids[r]) if r < len(tree.ids) else None for r in rows]


def nearest(k: int):
    def run(batches):
        for tree, ids, labels, q, row in pairs_of(batches):
            of = np.arange(len(ids))
            far = np.full(len(ids), np.inf)
            found, there = best(tree, q, labels, ids, of, -far, far, True, k)
            at, col = np.nonzero(there)
            scores, partners = keys_apart(tree, found[at, col])
            yield pa.RecordBatch.from_arrays([
                pa.array([row["block"].as_py()] * len(at), pa.int64()), pa.array(at, pa.int32()),
                pa.array(partners, pa.int64()), pa.array(scores, pa.int64())], schema=NEAR)

    return run


HARD = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("nth", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()),
                  ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])
HARD_TYPE = "block long, at int, nth int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def inside_windows(low: int, high: int, k: int):
    def run(batches):
        for tree, ids, labels, q, row in pairs_of(batches):
            wanted = row["positives"].as_py()
            of = np.array([w["at"] for w in wanted], dtype=np.int64)
            scores = [w["score"] for w in wanted]
            floors = np.array([-(-low * s // 100) for s in scores], dtype=np.int64)
            tops = np.array([high * s // 100 for s in scores], dtype=np.int64)
            found, there = best(tree, q, labels, ids, of, floors, tops, False, k)
            at, col = np.nonzero(there)
            negatives, partners = keys_apart(tree, found[at, col])
            yield pa.RecordBatch.from_arrays([
                pa.array([row["block"].as_py()] * len(at), pa.int64()), pa.array(of[at], pa.int32()),
                pa.array([wanted[i]["nth"] for i in at], pa.int32()), pa.array(ids[of[at]], pa.int64()),
                pa.array([wanted[i]["vec_id"] for i in at], pa.int64()), pa.array([scores[i] for i in at], pa.int64()),
                pa.array(partners, pa.int64()), pa.array(negatives, pa.int64())], schema=HARD)

    return run


def first_of(df: DataFrame, keys: list[str], score: str, ident: str, k: int, rank: str) -> DataFrame:
    """The k rows of highest score per key, ties by least id (rows without one last); Spark cuts each partition to k a key first."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(ident))
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's vector is floor(scale * x); scores are integer inner products.  ``anchors`` is a condition on ``rows``; an
    anchor's positives are the ``positives`` rows of highest score with its label and another id, and for each of them
    the ``negatives`` rows of highest score with another label are returned whose score lies within ``low`` to ``high``
    hundredths of the positive's.  Ties go to the smaller id.

    Rows are put into trees where they lie, at most TREE_ROWS each, so nothing is shuffled to build them and no task grows with
    the table; the trees are written to the shared folder once.  Anchors travel, in blocks, to every tree (by a hash
    of the tree; the number of pairs is that of blocks times trees), and what returns is at most k rows per window and tree.

    Rows with a null label or vector, or a null or non-finite component, take no part; rows with a null id are no anchors and come last in ties.
    Vectors of different lengths are compared as if the shorter went on with zeros.  Repeated rows count as rows, but rows of one id are
    never each other's positives; a repeated anchor gives its rows again.  Other columns are ignored; an empty table gives no rows.
    Scores beyond 2^49 are computed with whole numbers of any size; one beyond 64 bits stops the job with an error.
    """
    narrow = lambda df: df.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    trees = landed(narrow(rows).mapInArrow(make_trees(scale), TREE_TYPE).withColumn("tree", F.monotonically_increasing_id()), "cover-trees")
    blocks = landed(narrow(rows.where(anchors & F.col(vec_id).isNotNull())).mapInArrow(make_blocks(scale), BLOCK_TYPE).withColumn(
        "block", F.monotonically_increasing_id()), "anchor-blocks")
    keys = max(trees.count(), 1)
    homes = trees.withColumn("key", F.pmod(F.xxhash64("tree"), F.lit(keys))).repartition(keys, "key")

    def meet(sent: DataFrame) -> DataFrame:
        every = sent.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(keys - 1).cast("long"))))
        return homes.join(every.repartition(keys, "key"), "key")  # a tree is followed by all blocks

    near = meet(blocks).mapInArrow(nearest(positives), NEAR_TYPE)
    chosen = first_of(near, ["block", "at"], "score", "vec_id", positives, "nth")
    # At most BLOCK_ROWS times ``positives`` short entries in a list.
    wanted = chosen.groupBy(F.col("block").alias("of_block")).agg(F.collect_list(F.struct("at", "nth", "vec_id", "score")).alias("positives"))
    asked = landed(blocks.join(wanted, F.col("block") == F.col("of_block")).drop("of_block"), "anchor-windows")
    hard = meet(asked).mapInArrow(inside_windows(low, high, negatives), HARD_TYPE)
    return first_of(hard, ["block", "at", "nth"], "negative_score", "negative_id", negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
