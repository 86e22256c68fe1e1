from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm.queries import QUERIES, oracle_sql

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "substring dedup", "secret scans", "packing"]
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(oracle_sql()) <= set(QUERIES)


def test_run_over_documents(spark, tmp_path, odd_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mixed = docs.unionByName(odd_docs.select([F.col(c).cast(t) for c, t in docs.dtypes]))
    mixed.write.parquet(str(tmp_path / "documents.parquet"))
    held, docs = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    columns = held.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, held, str(tmp_path))
        assert made.columns == columns, name
        made.write.parquet(str(tmp_path / name.replace(" ", "-")))
        held = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    pieces = corpus_pipeline.packing(spark, held, str(tmp_path))
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in held.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == pieces.count()
