"""Near copies against all pairs by brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import near_copies as nc


def _grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else None


def brute(rows):
    """doc_id -> class_id, text_id, n_copies, n_links, with unique ids."""
    sets = {i: _grams(t) for i, t in rows}
    same = {i: min(j for j in sets if sets[j] == sets[i]) if sets[i] else i for i in sets}
    heads, root = sorted(set(same.values())), {i: i for i in sets}
    near = {h: 0 for h in heads}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(heads, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            near[a] += 1
            near[b] += 1
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (find(same[i]), same[i], sum(same[j] == same[i] for j in sets) - 1 if sets[i] else 0, near[same[i]]) for i in sets}


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows), "Too Short"), (len(rows) + 1, "too, short"), (len(rows) + 2, ""), (len(rows) + 3, None), (len(rows) + 4, "...")]
    return rows


@pytest.mark.parametrize("block", [3, 512])
def test_against_all_pairs(spark, monkeypatch, copies, block):
    monkeypatch.setattr(nc, "BLOCK_CLASSES", block)
    got = nc.near_copies(spark.createDataFrame(copies, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.class_id, r.text_id, r.n_copies, r.n_links) for r in got} == brute(copies)
    assert len(got) == len(copies)
    assert any(r.n_links > 1 for r in got) and any(r.n_copies for r in got)


def test_texts_without_an_id_keep_their_links(spark):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join([*base[:-1], "y"])]
    got = nc.near_copies(spark.createDataFrame([(1, texts[0]), (2, texts[1]), (None, texts[2]), (None, texts[2])], "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.class_id, str(r.text_id), r.n_copies, r.n_links) for r in got) == [
        ("1", 1, "1", 0, 2), ("2", 1, "2", 0, 2), ("None", 1, "None", 1, 2), ("None", 1, "None", 1, 2)]


def test_texts_that_share_an_id_are_judged_each_by_itself(spark):
    base, other = [f"w{k}" for k in range(60)], " ".join(f"v{k}" for k in range(50))
    one, near = " ".join(base), " ".join([*base[:-1], "x"])
    rows = [(1, one), (7, near), (7, other), (7, other), (8, other), (9, ""), (9, "..."), (9, ""), (None, near), (None, "lone words here"), (None, "lone words, here"), (None, None), (None, None)]
    left = nc.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = [(1, one), (7, other), (9, ""), (9, "..."), (None, "lone words here"), (None, None)]
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, want))
    nameless = nc.one_of_each(spark.createDataFrame([(None, one), (None, near), (None, other)], "doc_id bigint, text string")).collect()
    assert len(nameless) == 2 and other in [r.text for r in nameless]


def test_banding_reaches_its_recall():
    bands, rows = nc.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert bands * rows <= nc.MOST_HASHES
    with pytest.raises(ValueError):
        nc.banding(0.01, 0.9999)


def test_similarity_at_the_border():
    a, b = np.arange(0, 9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)  # 8 of 10
    assert len(nc.links([a, b], 0.8)[0]) == 1
    assert len(nc.links([a, np.arange(1, 11, dtype=np.uint64)], 0.8)[0]) == 0  # 8 of 11


def test_one_of_each(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id bigint, text string")
    left = nc.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(k for k, v in brute(copies).items() if v[0] == k)


def test_odd_rows(spark, odd, odd_rows, nothing):
    got = nc.near_copies(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got}
    assert by[2].class_id == 1 and by[2].n_copies == 3 and by[3].class_id == 3 and by[3].n_links == 0
    left = nc.one_of_each(odd).collect()
    nameless = [r for r in got if r.doc_id is None and r.class_id is None]
    assert sorted(str(r.doc_id) for r in left) == sorted(["1", "3", "4", "5", "6", "7", "10"] + ["None"] * len(nameless) + [k for k in ("8", "9") if by[int(k)].class_id == int(k)])
    twice = nc.one_of_each(odd.where("doc_id = 2")).collect()
    assert len(twice) == 1 and twice[0].source == "a"
    assert nc.near_copies(nothing).count() == 0 and nc.one_of_each(nothing).count() == 0
