"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame; the caller writes
it as Parquet and reads it again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

1. language ID drops documents that show none of the learnt languages;
2. line dedup cuts repeated lines of four or more words, the shorter lines that repeat
   beside them and repeated runs, and drops documents of which nothing is left;
3. MinHash near-dedup keeps the smallest doc_id of each class;
4. substring dedup cuts words covered by 13-word windows that a smaller
   doc_id has, and drops documents of which nothing is left;
5. best-fit packing places every document's token pieces in sequences.

``n_chars`` follows the text wherever a stage cuts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.llm import langid, lines, minhash, substring
from costweave.llm.common import read_table
from costweave.llm.queries import packed_documents
from costweave.session import scratch_path

#: DuckDB SQL for run()'s rows: the stages learn and tokenise, SQL can't.
ORACLE_SQL = None


def _with_text(cut: DataFrame, columns: list[str], removed: str) -> DataFrame:
    """The columns of documents after a cut: counted anew where something went,
    without the documents of which nothing is left."""
    gone = F.col(removed) > 0
    rows = cut.filter(~(gone & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")))
    if "n_chars" in columns:
        kind = cut.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(gone, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    scored = langid.identify(docs, model, lang="pipeline_lang_pred", score="pipeline_score", sure="pipeline_sure")
    return scored.filter("pipeline_sure").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(lines.remove_lines(docs, n_lines="pipeline_n_lines", n_removed="pipeline_n_removed"),
                      docs.columns, "pipeline_n_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = minhash.classes(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    kept = docs.join(gone.hint("shuffle_hash"), F.col("doc_id") == F.col("gone_id"), "left_anti")
    return kept.select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(substring.remove_repeats(docs, n_words="pipeline_n_words", n_removed="pipeline_n_removed"),
                      docs.columns, "pipeline_n_removed")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the checkpoint folder and reread."""
    base = scratch_path(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
