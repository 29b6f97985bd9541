import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.texts import flat
from tidemark.session import scratch_dir

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TRICKY = [
    "Hello, world's 2nd test!! it'S they'Re 'sun", "  leading\n\nand trailing  ", "ÀÉÎ é ́x á, ﬁ ½ Σας İstanbul", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "a|b ||c| '' '' 's",
    "日本語 テスト 🎉🎉", "tab\tnew\rline nbsp x", "x" * 500, "12345 3.14 a1b2", "", "!'s", "\u0000\u0001", "The end.The END"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def want(tokenizer, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = ids_of(tokenizer, text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_give_the_ids_of_the_whole_text(tokenizer):
    import pyarrow as pa

    coder = token_files.PieceEncoder(PATH)
    for texts in (TRICKY, [t for t in TRICKY if "<|" not in t], TRICKY[:1] * 3):
        ids, counts = coder.encode(*flat(pa.array(texts)))
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == ids_of(tokenizer, t)[:-1], t


@pytest.mark.parametrize("shard_ids", [40, 1 << 21])
def test_round_trip(spark, tokenizer, odd_rows, shard_ids):
    rows = [r[:2] for r in odd_rows] + [(100 + i, t) for i, t in enumerate(TRICKY)]
    folder = scratch_dir(spark, "shards")
    token_files.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), folder, PATH, shard_ids=shard_ids)
    got = token_files.read(spark, folder).drop("ordinal").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want(tokenizer, rows)
    token_files.write_directory(spark, folder)
    found = {r.doc_id: r.ids for r in token_files.fetch(spark, folder, [100, 1, 999]).collect()}
    assert found == {100: ids_of(tokenizer, TRICKY[0]), 1: ids_of(tokenizer, odd_rows[0][1])}


def test_fetch_opens_only_shards_that_can_hold_the_key(spark, tokenizer):
    folder = scratch_dir(spark, "shards")
    docs = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(300)] + [(None, "no id")], "doc_id bigint, text string")
    token_files.write(docs, folder, PATH, shard_ids=100)
    token_files.write_directory(spark, folder)
    shards = spark.read.parquet(f"{folder}/_directory").count()
    one = token_files.fetch(spark, folder, [77, 77])
    assert shards > 30 and len(one.inputFiles()) == 1
    assert [tuple(r) for r in one.collect()] == [(77, ids_of(tokenizer, "text number 77 " * 5))]
    assert token_files.fetch(spark, folder, [1000]).count() == 0 and token_files.fetch(spark, folder, []).count() == 0
    assert token_files.read(spark, folder).count() == 301


def test_empty_table(spark, nothing):
    folder = scratch_dir(spark, "shards")
    token_files.write(nothing, folder, PATH)
    assert token_files.read(spark, folder).count() == 0
    token_files.write_directory(spark, folder)
    assert token_files.fetch(spark, folder, [1]).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    index = token_files.PerfectHash.build(hashes)
    assert sorted(index.slots(hashes)) == list(range(len(hashes)))
    shard = token_files.Shard(token_files.pack(np.arange(5), np.zeros(5, np.int32), np.zeros(5, np.uint8), np.array([1, 0, 2, 3, 1]), np.arange(7, dtype=np.uint16), 0, 0))
    assert [shard.get(k).tolist() for k in range(5)] == [[0], [], [1, 2], [3, 4, 5], [6]]
    assert sum(shard.get(k) is not None for k in range(5, 2000)) == 0 and shard.get(None) is None


def test_pieces_stay_with_the_worker_and_digits_are_cut():
    import random

    import pyarrow as pa

    encoder = token_files.worker_encoder(PATH)
    assert token_files.worker_encoder(PATH) is encoder
    rng = random.Random(5)
    texts = ["".join(rng.choice(["12", "7", "3.5", "a", "Word", "'s", "'", "|", " ", "\n", "é", "5\u0301", "٣", "½", ",", "(9)", "🙂", "<|endoftext|>" if k % 9 == 0 else "<|"]) for _ in range(40)) for k in range(300)]
    want = encoder.whole.encode_batch(texts, add_special_tokens=False)
    for some in ([k for k in range(300) if "<|" not in texts[k]], range(300)):
        ids, counts = encoder.encode(*flat(pa.array([texts[k] for k in some])))
        assert ids.tolist() == [i for k in some for i in want[k].ids] and counts.tolist() == [len(want[k].ids) for k in some]
    # Long numbers teach no pieces of their own.
    known = len(encoder.code)
    ids, _ = encoder.encode(*flat(pa.array([" ".join(str(rng.randrange(10**12)) for _ in range(500))])))
    assert len(encoder.code) - known <= 20 and (np.array(ids) > 0).all()
