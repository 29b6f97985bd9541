import zlib

import pytest

from tidemark.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.93 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_only_text_predicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs)
    swapped = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    key = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in language.predict(df, model).collect())
    assert key(docs) == key(swapped)


def test_odd_rows(spark, odd, odd_rows, nothing):
    got = language.report(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == "und" and by[3].score == 0
    assert by[10].lang_pred in {"en", "fr", "de"}
    assert language.report(nothing).count() == 0
    alone = language.predict(odd, {"en": b"the cat sat on the mat"}).where("doc_id = 6").first()
    assert (alone.lang_pred, alone.score) == ("en", 1.0)
    assert {r.lang_pred for r in language.predict(odd, {}).collect()} == {"und"}


def test_copies_do_not_shrink_the_sample(spark):
    few = [f"rare{k} " * 40 for k in range(11)]
    rows = [("yy", f"plain{k} words of another language") for k in range(400)] + [("xx", "one hot text " * 30)] * 6000 + [("xx", t) for t in few]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert all(f"rare{k} ".encode() in model["xx"] for k in range(11))


def test_every_language_has_a_text(spark):
    rows = [(f"l{n}", f"language {n} text {k}") for n in range(20) for k in range(30)]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"), sample_texts=1)
    assert len(model) == 20 and all(model.values())


def test_few_long_texts_fill_the_dictionary(spark):
    rows = [("xx", " ".join(f"w{n}x{k}" for k in range(20_000))) for n in range(2)]
    assert len(language.fit(spark.createDataFrame(rows, "lang string, text string"))["xx"]) == language.DICTIONARY_BYTES


def test_narrow_margins_are_rejected():
    model = language.Compressors({"a": b"abcdefgh" * 50, "b": b"abcdefgh" * 50})
    assert model.predict("abcdefgh and so on") == ("a", 0.0, False)
    assert language.Compressors({"a": b"one two three four five " * 30, "b": b"xyzzy plugh " * 30}).predict("one two three four five six")[2]


@pytest.mark.parametrize("sizes", [[10], [5, 500], [100] * 9])
def test_dictionaries_keep_to_their_size(sizes):
    assert len(language._cut([b"x" * n for n in sizes], 300)) <= 300
