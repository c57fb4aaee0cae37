"""A training corpus from raw documents: rules, classifier, near copies, mix, piece ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm import gam, jaccard, mixing, pieces, quality_rules
from loghaven.llm.common import one_label


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_label(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Documents whose other columns have private names, so that no operator replaces them, and the way
    back to the columns of the documents."""
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    back = [F.col(names.get(c, c)).alias(c) for c in docs.columns]
    return docs.toDF(*[names.get(c, c) for c in docs.columns]), lambda rows: rows.select(*back)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rows, back = _apart(docs)
    return back(quality_rules.quality_rules(rows, _labels(spark, sf_dir))[0].where("kept"))


def keep_by_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model predicts to be good."""
    rows, back = _apart(docs)
    return back(gam.quality_model(rows, _labels(spark, sf_dir)).where("predicted = 1"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar documents: five words, similarity 0.8."""
    rows, back = _apart(docs)
    return back(jaccard.without_near_copies(rows, one_row=True))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows, back = _apart(docs)
    mixed = mixing.mix_sources(rows).where("copies > 0")
    return back(mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document of the mix."""
    rows = pieces.encode_documents(docs.select("doc_id", "lang", "source", "text"))
    return rows.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_model),
    ("n-gram Jaccard join", one_of_near_copies),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: Learned rules, a fitted model, hashes and piece ids are beyond SQL; tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "pipeline")
    return docs
