"""The corpus pipeline: stages in order, their decisions, and how they fit together."""

import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from adlumen.llm import common
from adlumen.llm.queries import ORACLE, QUERIES
from conftest import TABLES


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, over its predecessor's rows."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    more = spark.createDataFrame([(7001, "مرحبا بك", None, "s", 8), (7002, None, "en", None, None), (None, "the of and words with no id", None, None, None)], docs.schema)
    held = [docs.unionByName(more)]
    for name, stage in corpus_pipeline.STAGES:
        held.append(common.stored(stage(spark, held[-1], TABLES), name))
    return held


def test_all_operators_have_a_query():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.compare(QUERIES[name](spark, TABLES), compare.oracle_connection(TABLES), ORACLE[name]) is None


def test_stages_keep_the_columns_and_only_drop_rows(stages):
    documents = stages[0]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.dtypes == documents.dtypes
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()


def test_language_stage_drops_only_unknown_texts(stages):
    gone = {r[0] for r in stages[0].select("doc_id").exceptAll(stages[1].select("doc_id")).collect()}
    assert gone == {7001, 7002}
    assert stages[1].where("lang is null").isEmpty()


def test_line_stage_leaves_no_line_twice(stages):
    lines = stages[2].where("doc_id is not null").select(F.explode(F.split("text", "\n")).alias("line")).select(F.trim("line").alias("line")).where("line <> ''")
    assert lines.groupBy("line").count().where("count > 1").isEmpty()
    kept = {r.doc_id: r for r in stages[2].collect()}
    for r in stages[1].collect():
        if r.doc_id in kept:
            assert set(kept[r.doc_id].text.split("\n")) <= set(r.text.split("\n")) and kept[r.doc_id].n_chars == len(kept[r.doc_id].text)


def test_no_near_duplicates_or_leaks_are_left(spark, stages):
    sets = {}
    for r in stages[3].collect():
        w = r.text.lower().split()
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    ids = sorted(k for k in sets if k is not None)
    for a in ids:
        assert all(100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]) for b in ids if b > a)
    items = [r.text.lower().split() for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    for r in stages[4].collect():
        text = f" {' '.join(r.text.lower().split())} "
        assert not any(f" {' '.join(i)} " in text for i in items)
    leaky = [r for r in stages[3].collect() if any(f" {' '.join(i)} " in f" {' '.join(r.text.lower().split())} " for i in items)]
    assert stages[4].count() == stages[3].count() - len(leaky)


def test_packing_stage_holds_every_document(spark, stages):
    assert stages[5].select("doc_id").distinct().count() == stages[4].count()
    assert stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_run_gives_what_the_stages_give(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, TABLES), "again")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert corpus_pipeline.run(spark, TABLES).select(key).exceptAll(docs.select(key)).isEmpty()
