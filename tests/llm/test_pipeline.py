import duckdb
import pytest

import corpus_pipeline
from ledgermill.llm import queries
from ledgermill.llm.decontaminate import contamination
from ledgermill.sources.shared import materialise

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "benchmark"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        relation = db.sql(queries.oracle_sql()[name])
        columns = sorted(relation.columns)
        expected = sorted(relation.select(*columns).fetchall(), key=repr)
    result = queries.queries()[name](spark, FOLDER)
    assert sorted(result.columns) == columns
    assert sorted((tuple(r) for r in result.select(*columns).collect()), key=repr) == expected


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "minhash_dedup", "decontamination", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialise(stage(spark, docs, FOLDER))
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "line_dedup":
            assert docs.where("n_chars != length(text)").isEmpty()
    assert not contamination(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("contaminated").count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept["decontamination"]
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(packed)


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "1 2 3", "en", "s", 5), (3, "und", None, "s", 3), (3, "und", None, "s", 3)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, FOLDER).count() <= 5
