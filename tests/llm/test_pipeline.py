import corpus_pipeline as P
from drivelake.llm import quality_rules, secret_scan
from tests_llm_brute import brute, check_packing, library_text


def test_pipeline_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passed = {r.doc_id for r in quality_rules.assess(spark, docs).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in passed]
    firsts = {i for i, n, c in brute(rows, 5, 80) if c == i or not n}
    texts = {i: library_text(t) for i, t in rows if i in firsts}
    assert any("[assign]" in t or "[hex]" in t for t in texts.values()) or not any(secret_scan.RULES["hex@1"](t, t) for _, t in rows)
    check_packing(P.run(spark, sf_dir).collect(), texts)


def test_stages_keep_the_columns_and_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in P.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs, sf_dir).count() == docs.count()  # secrets drop nothing
