"""Top-k against brute force: early stops, ties, copies, nulls and large integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolens.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score int, part string"


def expected(rows, k, scale=256, step=50):
    good = [(i, [int(np.floor(scale * c)) for c in v]) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, q in good:
        if i % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, **how):
    v = spark.createDataFrame([(i, x, 7, "p") for i, x in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(v, v.where("vec_id % 50 = 0"), **how).collect())


def test_against_brute_force(spark):
    x = np.random.default_rng(2).normal(size=(700, 6)) / 3
    x[100:160] = x[100]  # a group of copies, with ties
    x[200] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(None, rows[3][1]), (900, None), (901, []), (902, [None] * 6), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (100, rows[100][1]), (950, rows[5][1])]
    for how in ({"shard": 64, "group": 5}, {}):
        assert run(spark, rows + odd, k=5, **how) == expected(rows + odd, 5)


def test_fewer_candidates_than_asked_and_none(spark):
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (50, [0.0, 0.0])]
    assert run(spark, rows, k=5) == expected(rows, 5)
    assert run(spark, [], k=5) == [] == run(spark, [(0, [1.0])], k=5)


def test_integers_beyond_doubles_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 20 - 3 * i), 1.0]) for i in range(120)]
    assert run(spark, rows, k=3) == expected(rows, 3)
    with pytest.raises(Exception, match="fit a long"):
        run(spark, [(0, [1e200, 1.0]), (1, [1.0, 1.0])], k=3)
    with pytest.raises(Exception, match="several lengths"):
        run(spark, [(0, [1.0, 1.0]), (1, [1.0])], k=3)


def test_lists_are_not_read_to_the_end_where_bounds_decide():
    rng = np.random.default_rng(4)
    x = rng.integers(-20, 20, (2000, 4))
    x[rng.choice(2000, 30, replace=False)] = rng.integers(200, 256, (30, 4))
    shard = topk.build(np.arange(2000), x)
    row, near, score, entries = topk.search(shard, np.array([-1]), np.array([[9, 8, 7, 5]]), 5)
    best = sorted((-int(s), i) for i, s in enumerate(x @ [9, 8, 7, 5]))[:5]
    assert [(-int(s), int(i)) for i, s in zip(near, score)] == best
    assert entries < x.size / 4


def test_bounds_hold_at_every_depth():
    x = np.random.default_rng(5).integers(-9, 9, (50, 5))
    q = np.random.default_rng(6).integers(-9, 9, (7, 5))
    for kind in (np.float64, np.int64):
        reader = topk.Reader(topk.build(np.arange(50), x), kind)
        for depth in topk.depths(50):
            reader.read(depth)
            upper, lower = reader.bounds(q.astype(kind))
            assert (lower <= q @ x.T).all() and (upper >= q @ x.T).all()
        assert (upper == lower).all()
