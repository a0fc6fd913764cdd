"""Ids that name several texts, columns that clash, and tables without rows or labels."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlumen.llm import common, line_dedup, substring_dedup, suffix_dedup
from conftest import TABLES
from llm.test_operators import brute_bytes, brute_words

PASSAGE = " ".join(f"shared{k}" for k in range(70))
ROWS = [
    (1, "line one of a document here\nline two of a document here\nline three of it\nline four of it"), (1, "short"), (1, "short"), (1, PASSAGE),
    (2, "other words before it " + PASSAGE), (2, "brief"), (2, "line two of a document here\nsomething of its own"), (3, "x " + PASSAGE + " y"), (3, None), (None, PASSAGE),
    (-9_000_000_000_000_000_000, "a " + PASSAGE[:400]), (9_000_000_000_000_000_000, "line one of a document hers\nthe end of it"), (9_000_000_000_000_000_000, PASSAGE[100:]),
]


@pytest.fixture(scope="module")
def shared(spark):
    common.ship(spark)
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_words_of_texts_that_share_an_id(shared):
    want = brute_words([(i, t, None) for i, t in ROWS], 13)
    got = substring_dedup.remove_repeats(shared).collect()
    assert order(got) == order((i, *x) for i, rows in want.items() for x in rows)
    assert any(r.n_removed for r in got if r.doc_id == 2) and all(r.n_removed == 0 for r in got if r.doc_id == -9_000_000_000_000_000_000)


def test_bytes_of_texts_that_share_an_id(shared):
    want = brute_bytes([(i, t, None) for i, t in ROWS], 200)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(shared).collect()]
    assert order(got) == order((i, *x) for i, rows in want.items() for x in rows)


def test_lines_of_texts_that_share_an_id(shared):
    got = line_dedup.remove_lines(shared)
    assert order(got.select("doc_id", "n_lines").collect()) == order((i, sum(bool(x.strip()) for x in (t or "").split("\n"))) for i, t in ROWS)
    kept = {(r.doc_id, r.n_lines, r.n_removed): r.kept for r in got.collect()}
    assert kept[2, 2, 1] == "something of its own" and kept[9_000_000_000_000_000_000, 2, 1] == "the end of it"
    assert kept[1, 4, 0] == ROWS[0][1] and kept[2, 1, 0] in ("brief", ROWS[4][1])


ODD = ["score", "rejected", "lang_pred", "gone", "kept", "a.b", "carried", "row", "id", "label", "_", "_hash", "key", "n", "packed"]


def test_stages_leave_columns_of_any_name_alone(spark):
    common.ship(spark)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where("doc_id < 60")
    more = spark.createDataFrame([(7, "another text of the seventh and the first", "en", "s", 3), (None, None, None, None, None)], docs.schema)
    docs = docs.unionByName(more).select("*", *(F.concat(F.lit(f"{k} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(k) for k in ODD))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, TABLES), "stage")
        assert docs.dtypes == before.dtypes
        for r in docs.collect():
            assert all(r[k] == f"{k} {r.doc_id if r.doc_id is not None else 'none'}" for k in ODD)
    assert docs.count() > 20
    assert corpus_pipeline.STAGES[-1][1](spark, docs, TABLES).count() >= docs.count()


def test_without_labels_every_document_stays(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, docs, TABLES).count() == docs.count()


def test_stages_of_empty_tables(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, TABLES).count() == 0, name
