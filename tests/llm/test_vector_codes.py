import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import vector_codes


def brute(rows, entries=256, rounds=4):
    """Rows (id, label, vector) -> (id, code, error, label error, digest), with plain integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = -(-max(len(v) for *_, v in kept) // 4) * 4
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    w = width // 4
    parts = [[v[p * w : p * w + w] for p in range(4)] for *_, v in kept]
    books = [[list(x[p]) for x in parts[:entries]] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for x in parts:
                groups.setdefault(nearest(x[p], book)[1], []).append(x[p])
            for e, members in groups.items():
                book[e] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [[nearest(x[p], books[p]) for p in range(4)] for x in parts]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, label, _), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    return [(i, "".join(f"{e:02x}" for _, e in f), error, total[label], digest) for (i, label, _), f, error in zip(kept, found, errors)]


def rows_of(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width)) * 0.2
    return [(i * 3, int(rng.integers(3)), np.round(centres[rng.integers(9)] + rng.normal(size=width) * 0.1, 2).tolist()) for i in range(n)]


SCHEMA = "vec_id bigint, label int, embedding array<float>"


@pytest.mark.parametrize("entries", [5, 256])
def test_against_plain_rounds(spark, monkeypatch, entries):
    monkeypatch.setattr(vector_codes, "ENTRIES", entries)
    rows = rows_of(60, 8)
    rows += [(7, None, rows[0][2]), (7, None, rows[0][2]), (7, None, rows[5][2]), (None, 1, [0.5] * 8), (None, None, [-0.001] * 8), (8, 1, None), (10, 2, []), (11, 2, [1.0, None] * 4),
             (13, 2, [float("nan")] * 8), (14, 2, [float("-inf")] * 8), (16, None, [0.25, -0.5, 0.125]), (17, 0, rows[3][2])]
    rows = [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, entries)))


def test_none_and_few(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes.report(empty).count() == 0
    assert vector_codes.report(spark.createDataFrame([(1, 0, None)], SCHEMA)).count() == 0
    assert [r.code for r in vector_codes.report(spark.createDataFrame([(1, 0, [1.0] * 4)], SCHEMA)).collect()] == ["00000000"]
    with pytest.raises(Exception, match="exact integer"):
        vector_codes.report(spark.createDataFrame([(1, 0, [1e17] * 4)], SCHEMA))


def test_decode_gives_the_entries_back(spark):
    rows = rows_of(40, 8)
    vectors = spark.createDataFrame(rows, SCHEMA)
    books = vector_codes.codebooks(vectors)
    for r in vector_codes.decode(spark, vector_codes.encode(vectors, books), books).collect():
        x = [math.floor(1024 * float(np.float32(c))) for c in rows[r.vec_id // 3][2]]
        assert sum((a - b) ** 2 for a, b in zip(x, r.vector)) == r.error


def test_cells_prune_and_are_remembered(monkeypatch):
    rng = np.random.default_rng(3)
    book = vector_codes.CellBook(rng.integers(-500, 500, (256, 4)))
    rows = rng.integers(-500, 500, (3000, 4))
    rows = np.concatenate([rows, rows])
    index, distance = book.nearest(rows)
    square = ((rows[:, None] - book.entries) ** 2).sum(axis=2)
    assert (distance == square.min(axis=1)).all() and (index == square.argmin(axis=1)).all()
    assert book.evaluated < 0.2 * 256 * len(rows) and book.hits >= 3000
    monkeypatch.setattr(vector_codes, "CACHE_ENTRIES", 10)  # cells are dropped, results stay
    again, _ = book.nearest(rows)
    assert (again == index).all()


def test_ties_go_to_the_lower_entry():
    book = vector_codes.CellBook(np.array([[5, 5], [-5, -5], [5, 5], [5, -5]]))
    index, distance = book.nearest(np.array([[0, 0], [5, 5], [-1, -1], [1, -1]]))
    assert index.tolist() == [0, 0, 1, 3] and distance.tolist() == [50, 0, 32, 32]
