import corpus_pipeline as C

from . import cases
from .test_near_dup import brute


def tables(spark, tmp_path, rows):
    cases.documents(spark, rows).drop("score", "component_id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (4, 0), (12, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, cases.text(40, 2))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_keep_their_columns(spark, tmp_path):
    at = tables(spark, tmp_path, cases.TEXTS)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns and out.count() <= docs.count()
    assert C.run(spark, at).count() > 0


def test_stages_decide(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = C.drop_duplicates(spark, docs, sf)
    want = {i for i, (_, c) in brute([(r.doc_id, r.text) for r in docs.collect()]).items() if i == c}
    assert {r.doc_id for r in kept.collect()} == want
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = C.drop_leaks(spark, docs, sf).collect()
    assert not any(b in r.text for r in clean for b in bench) and len(clean) > 0.9 * docs.count()


def test_nothing_in_nothing_out(spark, tmp_path):
    assert C.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_what_the_operator_calls_toxic_goes(spark, tmp_path, monkeypatch):
    at = tables(spark, tmp_path, [(i, cases.text(20, i)) for i in range(6)])
    docs = spark.read.parquet(f"{at}/documents.parquet")
    monkeypatch.setattr(C.toxicity, "train", lambda docs, labels: None)
    monkeypatch.setattr(C.toxicity, "score", lambda docs, model, name: docs.withColumn(name, docs.doc_id / 10))
    assert {r.doc_id for r in C.drop_toxic(spark, docs, at).collect()} == {0, 1, 2}


def test_columns_of_any_name_pass_through(spark, tmp_path):
    at = tables(spark, tmp_path, cases.TEXTS)
    names = ["toxicity_score", "Language_Found", "language_share", "component_id", "kept", "score", "digest", "place", "_"]
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for name in names:
        docs = docs.withColumn(name, C.F.lit(name))
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns
        assert all(r[n] == n for r in out.collect() for n in names)
    assert C.STAGES[-1][1](spark, docs, at).count() > 0


def test_all_but_the_result_is_removed(spark, tmp_path):
    at = tables(spark, tmp_path, cases.TEXTS[:6])
    before = cases.written_tables(spark)
    C.run(spark, at).count()
    assert [p.name.split("-")[0] for p in cases.written_tables(spark) - before] == ["packing"]
