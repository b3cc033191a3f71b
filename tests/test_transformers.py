from paddock.queries import load, registry


def test_terms_of_repeated_documents_count_once(spark, tmp_path):
    load()
    texts = [(i, "common " * 3 + f"own{i}") for i in range(6)] + [(7, "other word"), (7, "other common"), (None, "common other"), (None, "other")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.QUERIES["m23_count_vectors"](spark, str(tmp_path))
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.n_terms) for r in found.collect())
    assert rows == [(-1, 0), (-1, 0), *[(i, 1) for i in range(6)], (7, 1), (7, 1)]


def test_terms_of_a_document_need_no_shuffle(spark, tmp_path):
    load()
    spark.createDataFrame([(i, "a b c a") for i in range(6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.QUERIES["m23_count_vectors"](spark, str(tmp_path))
    assert {r.n_terms for r in found.collect()} == {3}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [doc_id" in plan and not any("Aggregate [doc_id" in line and "word" in line for line in plan.splitlines())
