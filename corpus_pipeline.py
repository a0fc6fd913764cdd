"""A training corpus from documents: five stages, each a text operator over all that came before.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All
but the last return the columns of ``documents``. ``run`` applies them and writes what each stage
kept to the shared scratch folder, so no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.llm import common, decontaminate, language, line_dedup, near_dedup, packing

# Tokens, fitted vectors and components cannot be expressed in SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


# A task holds a batch several times over: in the JVM, as Arrow and as Python strings.
BATCH_BYTES = "4m"


def _ready(spark: SparkSession) -> None:
    common.ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _whole(docs: DataFrame) -> Column:
    """All columns in a struct ``row``, where their names can meet no other."""
    return F.struct(*map(_column, docs.columns)).alias("row")


def _taken_apart(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col("row").getField(k).alias(k) for k in columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones show; fills in missing languages.

    Null and empty texts and those without letters are in no language and go. Where no row has both
    a text and a language, nothing is known and every row stays. Repeated rows and rows that share
    an id or have none are judged one by one. No other column is changed, whatever its name. An
    empty table stays empty.
    """
    _ready(spark)
    model = language.fit(docs.select("text", "lang"))
    if not model.languages:
        return docs
    found = language.identify(docs.select("text", _whole(docs)), model).where("not rejected")
    row = F.col("row")
    return found.select(*(F.coalesce(row.getField(k), F.col("lang_pred")).alias(k) if k == "lang" else row.getField(k).alias(k) for k in docs.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat an earlier one; documents of which no line is left go.

    Null texts become empty ones; they and blank texts have no lines and stay. A document without an
    id stays whole. Rows that share an id are documents of their own. All other columns stay as they
    are, but n_chars, which follows the text. An empty table stays empty.
    """
    _ready(spark)
    others = [k for k in docs.columns if k not in ("text", "n_chars")]
    left = line_dedup.remove_lines(docs.select("text", *map(_column, others)), carry=others).where("n_removed < n_lines or n_removed = 0")
    kinds = dict(docs.dtypes)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast(kinds.get("n_chars", "long"))}
    return left.select(*(new[k].alias(k) if k in new else F.col("carried").getField(k).alias(k) for k in docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Null, empty and blank texts are near nothing and stay, as do rows without an id. Rows that share
    an id are one document and stay or go together. Other columns are not read. An empty table stays
    empty.
    """
    _ready(spark)
    gone = near_dedup.near_duplicates(docs.select("doc_id", "text")).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    left = docs.select("doc_id", _whole(docs)).join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    return _taken_apart(left, docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item to a contaminating share.

    Null and empty texts hold nothing and stay. Rows are judged one by one, whatever their ids; other
    columns pass through. Without an item, or without documents, nothing changes.
    """
    _ready(spark)
    left = decontaminate.clean(docs.select("text", _whole(docs)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _taken_apart(left, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in training sequences.

    A null text is empty and has the end token alone. Every row is packed, also repeated ones and
    those that share an id or have none. An empty table gives no pieces; other columns are not read.
    """
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
