import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import fill_middle

TEXTS = [
    "one two three four five", "", None, "  lead and trail  \n", "\t\n ", "é漢字 😀😀 ß x y\u0085z", "a <P> b", "<S>", "x <M", "P> <", "<", "$1 \\1 $& {a}", "nul \x00 in\x0bside", "<<P <S <M",
    "line\r\nline\nline", "z" * 5000, "wide " * 20000, " " * 3000 + "x" + " " * 3000]
UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def plain(doc_id, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    n, digest = len(units), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_against_plain_cuts(spark):
    rows = [(i * len(TEXTS) + k, t) for i in range(12) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    done = fill_middle.fill_in_middle(docs)
    got = done.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_report_has_both_digests(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for r in fill_middle.report(docs).collect():
        assert r.output_sha256 == hashlib.sha256(plain(r.doc_id, TEXTS[r.doc_id])[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows_and_names(spark, odd, odd_rows, nothing):
    named = odd.withColumn("form", F.lit(1)).withColumn("output", F.lit(2)).withColumn("_a", F.lit(3)).withColumn("n_units", F.lit("x"))
    got = fill_middle.fill_in_middle(named)
    assert {"doc_id", "n", "key", "ids"} <= set(got.columns) and "_a" not in got.columns
    want = sorted(map(str, ((r[0], *plain(r[0], r[1])) for r in odd_rows)))
    assert sorted(map(str, map(tuple, got.select("doc_id", "n_units", "form", "prefix_chars", "middle_chars", "output").collect()))) == want
    assert fill_middle.report(nothing).count() == 0 and fill_middle.report(odd).count() == len(odd_rows)


def test_stays_in_sql(spark, odd):
    plan = fill_middle.report(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("LogicalRDD")[0].replace("Exchange RoundRobin", "").replace("REPARTITION_BY_NUM", "")
