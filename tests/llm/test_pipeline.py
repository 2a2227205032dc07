"""The pipeline's stages take effect, keep columns, and survive odd inputs."""

import corpus_pipeline
from skumix.llm import quality_rules, secrets, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_operators_applied_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "toxicity", "simhash near-dedup", "secret scans", "packing"]
    kept = {r.doc_id for r in quality_rules.quality_metrics(docs).where("kept").collect()}
    d = corpus_pipeline.quality(spark, docs, SF).cache()
    assert d.columns == docs.columns and {r.doc_id for r in d.collect()} == kept
    score = {r.doc_id: r.predicted for r in toxicity.score_toxicity(d, labels).collect()}
    e = corpus_pipeline.ordinary(spark, d, SF).cache()
    assert e.columns == docs.columns and {r.doc_id for r in e.collect()} == {k for k, p in score.items() if not p}
    comp = {r.doc_id: r.component_id for r in simhash.simhash_components(e).collect()}
    f = corpus_pipeline.near_dedup(spark, e, SF).cache()
    assert f.columns == docs.columns
    assert sorted(r.doc_id for r in f.collect()) == sorted(k for k, c in comp.items() if k == c)
    g = corpus_pipeline.no_secrets(spark, f, SF).cache()
    before = {r.doc_id: r.text for r in f.collect()}
    assert g.columns == docs.columns and g.count() == f.count()
    for r in g.collect():
        assert r.text == secrets.redact_text(before[r.doc_id])
        assert not [s for s in secrets.find(r.text) if s[2] != "assign"]
    rows = corpus_pipeline.packed(spark, g, SF).collect()
    assert {r.doc_id for r in rows} == set(before)
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_run_over_odd_and_empty_tables(spark, docs, empty, tmp_path):
    for name, d in (("odd", docs), ("none", empty)):
        path = str(tmp_path / name)
        d.write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
        rows = corpus_pipeline.run(spark, path).collect()
        assert name != "none" or rows == []
