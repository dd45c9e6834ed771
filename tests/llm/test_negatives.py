"""Hard negatives against brute force, and the invariants of the trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50):
    """The contract, pair by pair in whole numbers."""
    good = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v], label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    last = lambda i: (i is None, i or 0)
    for a, va, la in good:
        if a is None or a % every:
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=False)), i, label) for i, v, label in good]
        positives = sorted(((s, i) for s, i, label in scored if label == la and i != a), key=lambda x: (-x[0], last(x[1])))[:5]
        for ps, p in positives:
            fits = sorted(((s, i) for s, i, label in scored if label != la and 50 * ps <= 100 * s <= 95 * ps), key=lambda x: (-x[0], last(x[1])))
            out += [(a, p, rank, i, ps, s) for rank, (s, i) in enumerate(fits[:3], 1)]
    return sorted(out, key=str)


def mined(df, every=50):
    return sorted((tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0).select(*NAMES).collect()), key=str)


def test_whole_table_equals_sql(spark, sf, con):
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = sorted(tuple(r) for r in queries.QUERIES["op13_hard_negatives"](spark, sf).select(*NAMES).collect())
    assert got and got == sorted(con.execute(queries.SQL["op13_hard_negatives"]).fetchall())


def test_odd_rows(spark):
    """Nulls everywhere, non-finite parts, ties, repeated rows and ids, other lengths, zero and negative vectors, other columns."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist(), int(i % 3)) for i in range(1, 160)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0, 1.0], 1), (200, None, 1), (250, [1.0, None, 0.0, 0.0], 1),
             (300, [float("nan")] * 4, 1), (350, [float("inf"), 0.0, 0.0, 0.0], 2), (400, [1.0, 2.0, 0.0, 1.0], None), (450, [2.0, 2.0], 1),
             (500, [], 2), (550, [0.0] * 4, 0), (600, [1.0, 1.0, 1.0, 1.0], 1), (601, [1.0, 1.0, 1.0, 1.0], 1), (602, [1.0, 1.0, 1.0, 1.0], 2),
             (603, [0.9, 0.9, 0.9, 0.9], 2), (603, [0.9, 0.9, 0.9, 0.9], 2), (650, [1e6, 1e6, -1e6, 5.0], 0), (651, [1e6, 9e5, -1e6, 5.0], 0),
             (652, [8e5, 9e5, -9e5, 5.0], 1), (-50, [1.5, 0.0, 0.25, 2.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vector", "tree", "block", "key", "at", "rank", "order", "score"):
        df = df.withColumn(name, F.lit("x"))
    assert mined(df) == brute(rows)
    assert mined(df.where("false")) == []
    assert mined(df.where("label = 1")) == []


def test_scores_of_any_size(spark):
    rows = [(0, [5e6, 5e6], 1), (1, [5e6, 4.5e6], 1), (2, [4e6, 4.5e6], 2), (3, [3.5e6, 3.5e6], 2), (4, [-5e6, -5e6], 2), (5, [-5e6, 1.0], 1)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []


def test_repeated_anchor_gives_its_rows_again(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2, 65536, 49152)] * 2


@pytest.fixture(scope="module")
def planted():
    """Clusters, one vector that a third of the rows share, and scattered vectors, as one tree."""
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(c, 6, (250, 12)) for c in rng.normal(0, 200, (8, 12))] + [np.tile(rng.normal(0, 90, 12), (1300, 1))])
    x = np.floor(np.vstack([x, rng.normal(0, 150, (400, 12))]))[rng.permutation(3700)]
    labels = rng.integers(0, 4, 3700)
    return np.arange(3700) * 3, labels, x


def test_tree_covers_and_separates(planted):
    tree = negatives.plant(*planted)
    y = negatives.augmented(tree.vectors)
    assert sorted(tree.order.tolist()) == list(range(3700))
    for i in range(len(tree.center)):
        inside = y[tree.start[i]:tree.stop[i]]
        assert tree.start[i] <= tree.center[i] < tree.stop[i]
        assert negatives.angles(inside, y[tree.center[i]]).max() <= tree.radius[i]
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        if tree.children[i]:
            assert sum(tree.stop[k] - tree.start[k] for k in kids) == tree.stop[i] - tree.start[i]
        else:
            leaf = inside if len(inside) <= negatives.LEAF_ROWS else None
            assert leaf is not None or tree.radius[i] <= 3 * negatives.ANGLE_SLACK
    assert tree.children.max() > 1


def test_descent_is_exact_and_skips(planted, monkeypatch):
    ids, labels, x = planted
    tree = negatives.plant(ids, labels, x)
    asked = np.arange(0, 3700, 37)
    q, own = x[asked], ids[asked]
    seen = []
    real = negatives.products
    monkeypatch.setattr(negatives, "products", lambda a, b: seen.append(len(a) * len(b)) or real(a, b))
    far = np.full(len(asked), np.inf)
    got, _ = negatives.best(tree, q, labels[asked], own, np.arange(len(asked)), -far, far, True, 5)
    score = (q @ x.T).astype(np.int64)
    for row, s, a in zip(got, score, asked, strict=True):
        fits = [(v, -i) for i, v in enumerate(s.tolist()) if labels[i] == labels[a] and i != a]
        assert sorted(negatives.keys_apart(tree, row)[0], reverse=True) == [v for v, _ in sorted(fits, reverse=True)[:5]]
        assert sorted(negatives.keys_apart(tree, row)[1]) == sorted(int(ids[-i]) for _, i in sorted(fits, reverse=True)[:5])
    assert sum(seen) < 0.75 * len(asked) * 3700  # nodes outside were not verified
