"""A corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns a DataFrame;
all but the last return the columns of documents. The caller writes every stage's result and reads it again.
Rows are judged by their texts, not by doc_id, which may repeat or be null. Null texts pass toxicity, line dedup and
decontamination and keep their null; as texts they are equal to each other and to every text without a word, so
the SimHash stage keeps one row of them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import bpe_fst, decontaminate, line_dedup, shared, simhash, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine rejects go. It is fitted on the tables' labelled sample."""
    return toxicity.drop_toxic(docs, toxicity.fit_on_tables(spark, sf_dir))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut from the texts; n_chars follows."""
    cut = line_dedup.line_dedup(docs).drop("n_lines", "n_removed")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that of the smallest id, a null id first, and one of its repeats."""
    rows = shared.materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")  # numbers that stay
    groups = simhash.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id")
    ids = rows.select("__row", F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct("id", "__row"))["__row"]  # nulls are smallest
    kept = groups.join(ids, "__row").groupBy("component_id").agg(first.alias("__row")).select("__row")
    return rows.join(kept, "__row", "left_semi").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, shared.table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of token ids and of the text decoded from them."""
    return bpe_fst.digest(docs, bpe_fst.rank_file())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: Learned and fuzzy stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = shared.materialize(docs, f"stage-{name}")
    return docs
