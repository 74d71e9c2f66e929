"""A corpus pipeline: quality classifier, quality rules, near-duplicates, mix, pieces.

Every stage treats rows one by one, whatever their ids: null and repeated ids stay apart,
and equal rows are copies of each other. A null text is an empty one; the classifier scores
it as one empty line, the rules reject it, and stages that get one all the same keep it.
Null sources form one source of the mix. Columns beside those of documents are dropped;
an empty table gives an empty result in every stage. Ties between copies go to the
smallest id, then to the first row. Very long texts are read whole by every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telestream.llm import merge_dropout, minhash_tensor, quality_crf, quality_rules, source_schedule
from telestream.llm.common import Workspace
from telestream.llm.queries import PIECE_BPE, table, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line classifier rejects; it learns from labels of ``docs``."""
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.keep(docs, model).select(*COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule or repeat themselves too much."""
    return quality_rules.keep(docs).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (five-word shingles, 0.8)."""
    return minhash_tensor.keep(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets: a document
    stands as often as the whole times the mix takes it, and once more if the part that
    is left is half of it or more. Only documents at the ends of blocks are taken in part,
    up and down alike, so a source's words stay within a few blocks of its target. A
    document without words takes nothing of any target and stays once."""
    keyed = Workspace(spark, "mix").table(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    mixed, _ = source_schedule.schedule(keyed, key="_row")
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    often = mixed.select("_row", times.alias("times")).filter("times > 0")
    return keyed.join(often, "_row").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each document that the mix holds; copies are cut on their own."""
    same = Window.partitionBy("doc_id", "_text").orderBy("doc_id")
    docs = docs.withColumn("_text", F.md5("text")).withColumn("again", F.row_number().over(same))
    return merge_dropout.encode(docs, tokenizer(PIECE_BPE), occurrence="again")


STAGES = [("quality classifier", classify), ("quality rules", rules), ("near-duplicates", distinct), ("source mix", mix), ("pieces", pieces)]

#: A fitted model and hashed segmentations cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = ws.table(docs, f"stage{k}")
    return docs
