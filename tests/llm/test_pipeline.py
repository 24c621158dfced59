import corpus_pipeline
from pyspark.sql import functions as F

from subledger.llm import decontaminate, nbsvm, quality_rules, simhash

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_run_chains_them(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "simhash near-dedup", "benchmark decontamination", "byte-level bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(df.columns == columns for df in kept[:-1])
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in kept]
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    judged = quality_rules.judge(kept[0], labels)
    assert ids[1] == {r["doc_id"] for r in judged.where("kept").collect()}
    model = nbsvm.fit(kept[1], labels.where(~nbsvm.held_out(F.col("doc_id"))))
    assert ids[2] == {r["doc_id"] for r in nbsvm.classify(kept[1], model).where("predicted = 1").collect()}
    assert ids[3] == {r["component_id"] for r in simhash.near_duplicates(kept[2]).collect()}
    leaks = decontaminate.contaminated(kept[3], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids[4] == ids[3] - {r["doc_id"] for r in leaks.collect()}
    assert ids[5] == ids[4] and kept[5].count() == len(ids[5])
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(good & ids[1] - ids[2]) <= 0.01 * len(good & ids[1])  # clean documents stay

    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, kept[5].collect()))


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("1 = 0").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
