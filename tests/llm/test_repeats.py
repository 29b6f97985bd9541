"""Removal of repeated strings against a search of every window."""

import hashlib
import random
from collections import Counter

import pytest

from tidemark.llm import queries, repeats


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, n=40):
    rng = random.Random(seed)
    letters = "abcdefghij éß漢"
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passage, base = text(130), text(300)
    rows = []
    for i in range(n):
        t = text(rng.randint(0, 150))
        kind = rng.randrange(6)
        if kind == 0:
            t += passage[rng.randrange(30) : rng.randint(90, 130)] + text(rng.randrange(60))
        elif kind == 1:
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(letters)
            t = "".join(t)
        elif kind == 2:
            t = text(20) + t[:40] * rng.randint(1, 4)
        elif kind == 3 and rows:
            t = rng.choice(rows)[1]
        elif kind == 4:
            t = rng.choice("xyz") * rng.randint(30, 120) + t
        rows.append((i, t))
    return rows


@pytest.mark.parametrize(("seed", "small"), [(1, 128), (2, 2), (3, 1)])
def test_against_every_window(spark, monkeypatch, seed, small):
    monkeypatch.setattr(repeats, "SMALL_BUCKET", small)
    rows = _rows(seed)
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length=40, gram=12)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows, 40)
    for r in got.where("kept is not null").collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_shuffled_ids_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_IDS", 0)
    rows = [(i // 3 if i % 5 else None, t) for i, t in _rows(4)]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, 12, False)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 40)


def test_odd_rows(spark, odd, odd_rows, nothing):
    got = repeats.report(odd)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in odd_rows], 400)
    assert repeats.report(nothing).count() == 0


def brute_words(rows, length):
    words = [(t or "").split() for _, t in rows]
    held = Counter(w for ws in words for w in {tuple(ws[k : k + length]) for k in range(len(ws) - length + 1)})
    out = []
    for (i, _), ws in zip(rows, words):
        shared = set()
        for k in range(len(ws) - length + 1):
            if held[tuple(ws[k : k + length])] > 1:
                shared.update(range(k, k + length))
        out.append((i, len(shared)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_shared_words(spark, seed):
    rng = random.Random(seed)
    some = lambda k: [rng.choice("a b ab ba c dd é 漢 abc".split()) for _ in range(k)]
    passage, base, rows = some(14), some(40), []
    for i in range(60):
        ws, kind = some(rng.randint(0, 30)), rng.randrange(6)
        if kind == 0:
            ws += passage[rng.randrange(5) : rng.randint(9, 14)] + some(rng.randrange(9))
        elif kind == 1:
            ws = [w if rng.random() < 0.95 else "zz" for w in base]
        elif kind == 2:
            ws = ws[:9] * 3
        elif kind == 3:
            ws = ["x"] * rng.randint(3, 15) + ws
        text = "".join(w + rng.choice([" ", "\n", "  "]) for w in ws)
        rows.append((i if i % 7 else None, rng.choice(rows)[1] if kind == 4 and rows else text or None))
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, 12, False, passage=8, passage_gram=3)
    assert sorted(((r.doc_id, r.n_shared_words) for r in got.collect()), key=str) == brute_words(rows, 8)


def test_passages_of_the_query(spark, tmp_path, odd, odd_rows, nothing):
    """Passages of over 50 words count, also below 400 bytes, in the query's own result; 50 words, or repeats within one document, do not."""
    passage = [f"w{k}" for k in range(51)]
    texts = ["one " + " ".join(passage), "\n".join(passage) + " two", " ".join(passage[1:]) + " three", " ".join(["again"] * 90)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_shared_words) for r in queries.op2_repeated_strings(spark, str(tmp_path)).collect()}
    assert {i: n for i, (_, n) in got.items()} == {0: 51, 1: 51, 2: 0, 3: 0} and not any(got[i][0] for i in (0, 1, 2))
    assert sorted(((r.doc_id, r.n_shared_words) for r in repeats.report(odd, 51).collect()), key=str) == brute_words([r[:2] for r in odd_rows], 51)
    assert repeats.report(nothing, 51).count() == 0
