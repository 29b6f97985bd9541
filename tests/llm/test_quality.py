import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.texts import flat


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.65, 0.9, 0.8, 0.75])
    votes = np.where((rng.random((20_000, 8)) < right) == truth[:, None], quality.GOOD, quality.BAD)
    votes[rng.random(votes.shape) < 0.3] = quality.NOTHING
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel.fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    assert np.abs(model.accuracies() - right).max() < 0.04
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_keeps_good_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {(r.quality, r.keep): r["count"] for r in quality.report(docs).select("doc_id", "keep").join(labels, "doc_id").groupBy("quality", "keep").count().collect()}
    good = got.get((1, True), 0) / (got.get((1, True), 0) + got.get((1, False), 0))
    junk = got.get((0, False), 0) / (got.get((0, False), 0) + got.get((0, True), 0))
    assert good > 0.98 and junk > 0.97


def _kind(text):
    words = text.split()
    share = lambda hits: sum(hits) / max(len(words), 1)
    if share(w == "|" for w in words) > 0.15:
        return "tables"
    if share(w[-3:] in ("%%%", "###", "&&&", "***", "$$$") for w in words) > 0.3:
        return "signs"
    if share(w.isupper() for w in words) > 0.4:
        return "capitals"
    return "repeats" if share(a == b for a, b in zip(words, words[1:])) > 0.2 else "other"


def test_rejects_every_kind_of_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.report(docs).select("doc_id", "keep").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    junk = [(_kind(r.text), r.keep) for r in rows if r.quality == 0]
    for kind in ("tables", "signs", "capitals", "repeats"):
        kept = [keep for k, keep in junk if k == kind]
        assert len(kept) > 100 and sum(kept) <= 0.03 * len(kept), kind
    assert sum(keep for _, keep in junk) <= 0.02 * len(junk)
    good = [r.keep for r in rows if r.quality == 1]
    assert sum(good) > 0.99 * len(good)


def test_bare_separators_are_an_objection():
    import pyarrow as pa

    at = quality.LABELLERS.index("separators")
    table = quality.votes(*flat(pa.array(["one | two | three | four | five", "one two three four five six seven eight nine " * 3 + "- ten", "one | two"])))
    assert table[:, at].tolist() == [quality.BAD, quality.GOOD, quality.NOTHING]


def _prose(k):
    """Some sentences of words of usual lengths, none of them said twice."""
    rng = np.random.default_rng(k)
    words = ["".join(rng.choice(list("aeioubdklmnrst"), n)) for n in rng.choice([2, 3, 3, 4, 5, 6, 7], 70)]
    words[::10] = [w.capitalize() for w in words[::10]]
    words[9::10] = [w + "." for w in words[9::10]]
    return " ".join(words)


def test_copies_do_not_empty_the_sample(spark):
    """Good texts stay however often each is repeated: the sample is of different texts, and all are taken where they are few."""
    few = spark.createDataFrame([(_prose(k),) for k in range(40)], "text string")
    many = few.crossJoin(spark.range(20_000)).select(F.monotonically_increasing_id().alias("doc_id"), "text")
    assert many.count() == 800_000
    assert quality.report(many).where("not keep").count() == 0
    junk = spark.createDataFrame([(-k, "BUY NOW!!! " * (9 + k)) for k in range(1, 30)], "doc_id bigint, text string")
    got = quality.report(many.unionByName(junk)).groupBy((F.col("doc_id") < 0).alias("junk"), "keep").count().collect()
    assert {(r.junk, r.keep) for r in got} == {(True, False), (False, True)}


def test_one_class_alone(spark):
    """Without a bad or a good text in the sample the label model's posterior decides."""
    prose = spark.createDataFrame([(k, _prose(k)) for k in range(20)], "doc_id bigint, text string")
    assert [r.keep for r in quality.report(prose).collect()] == [True] * 20
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id bigint, text string")
    assert [r.quality for r in quality.report(blank).collect()] == [0.0] * 3


def test_votes_on_plain_cases():
    import pyarrow as pa

    prose = "The harbour is quiet in the evening, and people walk along the wall. They talk of the sea and of the boats. " * 3
    table = quality.votes(*flat(pa.array([prose, prose.upper(), "go " * 60, "", None, "x"])))
    at = {name: k for k, name in enumerate(quality.LABELLERS)}
    assert table[0, at["capitals"]] == quality.GOOD and table[1, at["capitals"]] == quality.BAD
    assert table[2, at["repeats"]] == quality.BAD
    assert not table[3:].any()


def test_odd_rows(spark, odd, odd_rows, nothing):
    got = quality.classify(odd)
    assert got.columns == [*odd.columns, "quality", "keep"]
    rows = got.collect()
    assert len(rows) == len(odd_rows)
    assert all(r.quality == 0 and not r.keep for r in rows if not (r.text or "").strip())
    assert len({r.quality for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.good(odd).columns == odd.columns
    assert quality.report(nothing).count() == 0
