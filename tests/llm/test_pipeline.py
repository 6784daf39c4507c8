"""The whole pipeline on hand-made documents."""

from __future__ import annotations

import corpus_pipeline


def test_run(spark, tmp_path):
    words = [f"word{i}" for i in range(60)]
    good = " ".join(words)
    texts = [good, good, " ".join([*words, "more"]), "### $$$ " * 20, "other " + " ".join(words[::-1]) + " a@b.cd", "leak " + " ".join(f"item{i}" for i in range(30)), None, ""]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(sorted(r[0] for r in docs.select("doc_id").collect()))
    assert kept == [[0, 1, 2, 4, 5], [0, 4, 5], [0, 4], [0, 4]]
    assert docs.where("doc_id = 4").first()["text"].endswith("[EMAIL]")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r["doc_id"] for r in packed.collect()}) == [0, 4]


def test_stages_on_odd_rows(spark, tmp_path):
    """Repeated rows, rows without an id, null and empty texts, an empty table, columns of clashing names."""
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "k", "s", "f", 3), (1, good, "k", "s", "f", 3), (None, good + " tail", "k", "s", "f", 3), (2, None, None, "s", "f", 3), (3, "", "k", "s", "f", 3)]
    schema = "doc_id long, text string, kept string, stats string, found string, component_id int"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "none of these words is in any document")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, str(tmp_path))
            made = out.collect()
            if name == "best_fit_packing":
                continue
            assert out.columns == docs.columns
            ids = sorted(str(r["doc_id"]) for r in made)
            whole = ["1", "1", "2", "3", "None"]
            want = {"quality_rules": ["1", "1", "None"], "near_duplicates": ["1", "2", "3", "None"]}.get(name, whole)
            assert ids == (want if table is docs else [])
            assert all(r["stats"] == "s" and r["found"] == "f" for r in made)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in packed) == ["1", "1", "2", "3", "None"]
