"""The pipeline's stages against brute force, each on its own input, and run() against the stages."""

import corpus_pipeline
from test_decontaminate import brute as brute_leaks
from test_near_copies import brute as brute_copies


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    state = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in state.collect()}
        state = stage(spark, state, sf_dir).cache()
        after = {r.doc_id: r for r in state.collect()}
        if k < 4:
            assert state.columns == columns
        if name == "quality classifier":
            assert 0.8 * len(before) < len(after) < len(before)
        elif name == "near copies":
            want = brute_copies(sorted(before.items()))
            assert set(after) == {i for i, v in want.items() if v[0] == i} and len(after) < len(before)
        elif name == "decontamination":
            assert set(after) == {r[0] for r in brute_leaks(before.items(), benchmark) if not r[5]} and len(after) < len(before)
        else:
            assert set(after) == set(before)
        if name == "secrets":
            assert any("[SECRET]" in r.text for r in after.values())
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == sorted((r.doc_id, r.ids) for r in after.values())
    assert not any(r.ids is None for r in after.values())


def test_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" not in e.oracle_sql()
