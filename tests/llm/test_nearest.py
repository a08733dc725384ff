"""Nearest neighbours: recall at the registered factor, odd vectors, trees sent in proportion."""

import numpy as np
import pytest

from chronolens.llm import ann


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(range(len(x)) if ids is None else ids, x)], "vec_id long, embedding array<double>")


def plain(x, q, k):
    s = np.cumsum(x * x[q], axis=1)[:, -1]
    return [int(i) for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k]


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_recall_at_the_registered_factor(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 24)) + 2 * rng.normal(size=(10, 24))[rng.integers(0, 10, 2000)]
    v = frame(spark, x)
    got = by_query(ann.nearest(v, v.where("vec_id % 20 = 0"), k=10, shard=250))
    hits = [len(set(got[q]) & set(plain(x, q, 10))) for q in range(0, 2000, 20)]
    assert sum(hits) / (10 * len(hits)) >= 0.9


def test_many_copies_are_spread_and_exact(spark):
    x = np.random.default_rng(6).normal(size=(600, 6))
    x[100:400] = x[100]
    v = frame(spark, x)
    got = by_query(ann.nearest(v, v.where("vec_id % 50 = 0"), k=7, factor=1.0, shard=40, asked=3, leaf=8))
    assert got == {q: plain(x, q, 7) for q in range(0, 600, 50)}


def test_large_vectors_are_compared_with_all(spark):
    x = np.random.default_rng(7).normal(size=(200, 4))
    x[7] = [1e200, -1e200, 0, 0]
    x[20] = [1e200, 0, 0, 0]
    v = frame(spark, x)
    rows = ann.nearest(v, v.where("vec_id % 20 = 0"), k=5, factor=1.0, shard=30, leaf=8).collect()
    with np.errstate(over="ignore", invalid="ignore"):
        for q in range(0, 200, 20):
            mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
            assert [r.vec_id for r in mine] == plain(x, q, 5)
            assert [r.score for r in mine] == [float(np.cumsum(x[r.vec_id] * x[q])[-1]) for r in mine]


def test_repeated_rows_null_ids_and_other_columns(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0], "a"), (0, [1.0, 0.0], "a"), (1, [2.0, 0.0], "b"), (1, [2.0, 0.0], "b"), (None, [9.0, 9.0], "c"), (2, [0.0, 1.0], None)],
                              "vec_id long, embedding array<double>, shard string")
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(v, v.where("vec_id = 0"), k=3).collect())
    assert rows == sorted(2 * [(0, 1, 1, 2.0), (0, 2, 1, 2.0), (0, 3, 2, 0.0)])


def test_lengths(spark):
    with pytest.raises(ValueError, match="several lengths"):
        v = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
        ann.nearest(v, v)
