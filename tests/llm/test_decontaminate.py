import hashlib
import random
import re

import pytest

from tidemark.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w and i is not None else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog near the old river bank today"), (2, "Short one"), (10, "ÄÖ é 9z"), (3, None), (4, "..."), (None, "solo"), (2, "again here"), (5, "a a a a a a a a a a a a"), (6, "lone")]


def _docs():
    rng = random.Random(1)
    vocabulary = words(" ".join(t or "" for _, t in ITEMS)) + ["Xyz", "filler", "é", "9Z"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    whole = ITEMS[0][1]
    rows += [(50, "x " + whole.upper() + " y"), (51, whole[:40]), (52, whole + " " + whole), (53, "a " * 30), (54, "short"), (55, "SHORT-ONE!"), (56, "äÖ é,9Z ÄÖ É 9z")]
    return rows


@pytest.mark.parametrize("block_words", [1, 200_000])
def test_against_every_window(spark, block_words):
    rows = _docs()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.contamination(docs, benchmark, block_words=block_words).collect()
    want = {r[0]: r for r in brute(rows, ITEMS)}
    for r in found:
        assert (r.n_words, sum(h["last"] - h["first"] for h in r.hits), len(r["items"])) == want[r.doc_id][1:4], r.doc_id
    if block_words > 1:
        assert sorted(map(tuple, decontaminate.report(docs, benchmark).collect()), key=str) == brute(rows, ITEMS)
        assert sorted(r.doc_id for r in decontaminate.clean(docs, benchmark).collect()) == sorted(k for k, v in want.items() if not v[5])


def test_odd_rows(spark, odd, odd_rows, nothing):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert sorted(map(tuple, decontaminate.report(odd, benchmark).collect()), key=str) == brute([r[:2] for r in odd_rows], ITEMS)
    assert decontaminate.clean(odd, benchmark).columns == odd.columns
    assert decontaminate.clean(odd, benchmark.limit(0)).count() == len(odd_rows)
    assert decontaminate.report(nothing, benchmark).count() == 0
