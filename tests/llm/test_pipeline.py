import corpus_pipeline as cp
from pyspark.sql import functions as F

from tidemill.llm import decontaminate

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").persist()
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count(), name
    kept = cp.exact_dedup(spark, docs, SF)
    assert kept.select("text").distinct().count() == kept.count() == docs.select("text").distinct().count()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = cp.decontaminate(spark, docs, SF).collect()
    texts = [r.text.lower() for r in bench.collect()]
    assert not any(t in (d.text or "").lower() for d in clean for t in texts)
    hit = {r.id for r in decontaminate.contaminated_pairs(docs.withColumnRenamed("doc_id", "id"), bench).collect()}
    assert len(clean) == docs.count() - len(hit)


def test_run_packs_what_is_left(spark):
    rows = cp.run(spark, SF)
    lengths = rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert lengths and all(r.n <= 2048 for r in lengths)


def test_near_dedup_drops_rows_not_ids(spark):
    base = " ".join(f"w{i}" for i in range(80))
    clean, lone = " ".join(f"c{i}" for i in range(80)), " ".join(f"n{i}" for i in range(80))
    rows = [(1, base), (2, base + " x"), (2, clean), (None, base + " y"), (None, lone), (None, lone + " z"), (3, "short one"), (4, None)]
    got = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert len(got) == 5 and {(r.doc_id, r.text) for r in got} - {(None, lone), (None, lone + " z")} == {(1, base), (2, clean), (3, "short one"), (4, None)}


def test_every_stage_takes_an_empty_table_and_nulls(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars int"
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (2, "  ", "en", "s", 2), (3, "One plain line of words. " * 30, "en", "s", 9)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, columns)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(rows) if name != "pack" else (out.count() > 0) == bool(rows), name
    assert "ids" in out.columns and sum(len(r.ids) for r in out.collect()) >= len(odd)
