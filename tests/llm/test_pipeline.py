import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from edgewise.llm import decontaminate, quality, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other_and_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{len(seen)}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{len(seen)}")
        seen[name] = (before, docs)
        if len(seen) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans",
        "byte-level BPE encoding and decoding"]
    ids = {n: ({r.doc_id for r in a.select("doc_id").collect()}, {r.doc_id for r in b.select("doc_id").collect()}) for n, (a, b) in seen.items()}
    before, _ = seen["quality classifier"]
    kept = {r.doc_id for r in quality.quality_report(before, spark.read.parquet(f"{SF}/labels.parquet")).where("kept").collect()}
    assert ids["quality classifier"][1] == kept
    before, _ = seen["SimHash near-dedup"]
    assert ids["SimHash near-dedup"][1] == {r.component_id for r in simhash.near_duplicates(before).collect()}
    before, _ = seen["benchmark decontamination"]
    report = decontaminate.contamination_report(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids["benchmark decontamination"][1] == {r.doc_id for r in report.where("NOT contaminated").collect()}
    before, after = seen["secret scans"]
    assert ids["secret scans"][0] == ids["secret scans"][1]
    assert after.where("text rlike 'AKIA[A-Z0-9]{16}'").count() == 0
    assert after.where("n_chars != char_length(text)").count() == before.where("n_chars != char_length(text)").count()
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and docs.count() == after.count()


def test_run_is_the_chain_and_everything_is_registered(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert {"op1_decontaminate", "op9_secrets"} <= set(entry.oracle_sql())
