import math

import numpy as np
import pytest

from tidemark.llm import top_k


def brute(rows, k, every):
    ints = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(1024 * x) for x in v]
            ints[i] = min(ints.get(i, v), v)
    out = []
    for q in ints:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_against_all_scores(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    rows = [(i, np.round(rng.normal(size=6), 1).astype("float32").tolist()) for i in range(60)]
    rows += [(60, rows[3][1]), (61, rows[3][1]), (3, rows[3][1]), (62, None), (63, [1.0, None] * 3), (64, [float("nan")] * 6), (70, [float("inf")] * 6), (None, [1.0] * 6), (80, []), (90, [0.0] * 6), (5, [0.5] * 6), (100, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    ints = top_k.integer_vectors(vectors)
    got = top_k.search(ints, ints.where("id % 10 = 0"), 5, block)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_fewer_than_k_and_none(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert list(map(tuple, top_k.report(vectors).collect())) == [(0, 1, 1, 1024 * 1024 * 5)]
    assert top_k.report(vectors.where("vec_id = 0")).count() == 0
    assert top_k.report(vectors.limit(0)).count() == 0


def test_sums_beyond_64_bits_are_refused(spark):
    for great in (1e17, 4e6):
        vectors = spark.createDataFrame([(0, [great, 1.0]), (1, [great, 1.0])], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="64 bits"):
            top_k.report(vectors).collect()
    vectors = spark.createDataFrame([(0, [1e6, 1.0]), (1, [1e6, 1.0])], "vec_id bigint, embedding array<double>")
    assert [r.score for r in top_k.report(vectors).collect()] == [1024**2 * (10**12 + 1)]


def test_stops_before_the_end():
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(4000, 3)) * 1000).astype(np.int64)
    lists = top_k.SortedLists(np.arange(4000), vectors)
    _, _, scored = lists.best(0, vectors[0], 10)
    assert scored < 2000
