import random
from functools import cache
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import pieces
from tidemark.llm.texts import flat

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(MODEL)


def best_path(v, text):
    """(score, ids) over every way to cut the marked text into pieces and unknown characters."""
    word = text.encode()
    chars = [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]

    @cache
    def best(k):
        if not k:
            return 0.0, ()
        end, out = chars[k], None
        for j in range(k):  # longest last piece first
            raw = word[chars[j] : end]
            if raw in v.pieces:
                i, s = v.pieces[raw]
                ids = (i,)
            elif j == k - 1:
                s, ids = v.unknown, tuple(v.byte_ids[b] for b in raw)
            else:
                continue
            score, before = best(j)
            if out is None or score + s > out[0]:
                out = score + s, before + ids
        return out

    return best(len(chars) - 1)


def test_against_all_cuts(vocabulary):
    rng = random.Random(3)
    texts = ["hello world", "  two  marks", "ünïcødé 漢字 😀", "a\nb\n\n c", "▁ mark", "x"] + ["".join(rng.choice("the anér \n漢") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    coder = pieces.Encoder(vocabulary)
    ids, counts = coder.encode(*flat(pa.array(texts)))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == list(best_path(vocabulary, " " + t)[1]), t
    data, at = coder.decode(ids, counts)
    assert [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])] == texts


def test_ids_are_the_library_s(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(5)
    texts = ["understanding", "hello world", "  two  marks", "ünïcødé 漢字 😀", "a\nb\n\n c", "x", "=" * 99, "a" * 70]
    texts += ["".join(rng.choice("the anér\n漢字😀 _=-0123 abABinsozu") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").select("text").collect()]
    got = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4), MODEL).collect()
    assert len(got) == len(texts) and all(r.ids == model.encode(texts[r.doc_id]) for r in got)
    assert [r.n_tokens for r in got if r.doc_id == 0] == [1]


def test_prefixes_do_not_change_the_merges(vocabulary):
    search, rng = pieces.PrefixMerges(vocabulary), random.Random(7)
    words = sorted({" " + "".join(rng.choice("theandé漢字") for _ in range(rng.randint(1, 12))) for _ in range(500)} | {" é", " è", " ê"}, key=str.encode)
    for w in (w.encode() for w in words):
        symbols = search.merged(w)
        assert search.encode(w) == [i for s in symbols for i in ([vocabulary.pieces[s][0]] if s in vocabulary.pieces else [vocabulary.byte_ids[b] for b in s])], w


def test_pairs_stay_apart_as_the_merges_say(vocabulary):
    search, rng = pieces.PrefixMerges(vocabulary), random.Random(9)
    known = [p for p in vocabulary.pieces if search.merged(p) == [p]]
    short = [p for p in known if len(p) < 4] + ["漢".encode(), b"q", b"a", b"="]
    pairs = [(rng.choice(known), rng.choice(known)) for _ in range(3000)] + [(rng.choice(short), rng.choice(short)) for _ in range(6000)]
    pairs += [(a, a) for a in rng.sample(known, 2000)] + [(p[:k], p[k:]) for p in rng.sample(known, 1500) for k in range(1, len(p))]
    seen = set()
    for a, b in pairs:
        if all(search.merged(x) == [x] for x in (a, b)):
            want = search.merged(a + b) == [a, b]
            assert search._left_apart(a, b) == want, (a, b)
            seen.add(want)
    assert seen == {True, False}


def test_merges_out_of_order_are_done_anew():
    scores = {b"a": 0, b"b": 0, b"c": 0, b"d": 0, b"bc": -9, b"abc": -3, b"cd": -5, b"ab": -12, b"abcd": -20, b"dd": -4}
    v = pieces.Vocabulary({p: (k, float(s)) for k, (p, s) in enumerate(scores.items())}, list(range(100, 356)), True)
    search, plain = pieces.PrefixMerges(v), pieces.PrefixMerges(v)
    for word in ("".join(w) for n in range(1, 8) for w in product("abcd", repeat=n) if n < 6 or w[0] < "b"):
        want = [i for s in plain.merged(word.encode()) for i in [v.pieces[s][0]]]
        assert search.encode(word.encode()) == want, word


def test_sorted_words_share_their_prefixes(vocabulary):
    search = pieces.PrefixViterbi(vocabulary)
    words = sorted([b" the", b" then", b" there", b" therefore", b" thereof"])
    shared = [search.encode(w) for w in words]
    assert search.reused > search.computed - len(words[-1])
    assert shared == [pieces.PrefixViterbi(vocabulary).encode(w) for w in words]


def test_pieces_may_not_cross_into_a_mark():
    with pytest.raises(ValueError):
        pieces.Vocabulary({b"a b": (0, 0.0)}, list(range(256)))


def test_frames(spark, odd, odd_rows, nothing):
    encoded = pieces.encode(odd, MODEL)
    back = pieces.decode(encoded.drop("text"), MODEL)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in odd_rows)
    got = pieces.report(odd, MODEL).collect()
    assert len(got) == len(odd_rows) and all(r.round_trip for r in got)
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (3, 4))
    assert pieces.report(nothing, MODEL).count() == 0 and pieces.encode(nothing, MODEL).count() == 0


def test_cut_lists_decode(spark, vocabulary):
    coder = pieces.Encoder(vocabulary)
    ids, _ = coder.encode(*flat(pa.array(["漢字 of the \U0001f984"])))
    rows = [(k, ids[k:].tolist()) for k in range(len(ids) + 1)] + [(100 + k, ids[:k].tolist()) for k in range(len(ids))] + [(999, None)]
    got = {r.doc_id: r.text for r in pieces.decode(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), MODEL).collect()}
    whole = coder.v.raw
    for k, cut in rows:
        raw = b"".join(whole[coder.v.raw_at[i] : coder.v.raw_at[i + 1]].tobytes() for i in cut or [])
        assert got[k] == raw.removeprefix(b" ").decode("utf-8", "replace")


def test_forgetting_words_changes_no_ids(monkeypatch, vocabulary):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 20)
    rng = random.Random(8)
    coder, fresh = pieces.Encoder(vocabulary), lambda: pieces.Encoder(vocabulary)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(12)) for _ in range(3)]
        assert [x.tolist() for x in coder.encode(*flat(pa.array(texts)))] == [x.tolist() for x in fresh().encode(*flat(pa.array(texts)))]
    assert len(coder.code) < 60
