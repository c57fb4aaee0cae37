"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.lake import stored, use_utc
from loghaven.llm import gam, hnsw, jaccard, licenses, lm, mixing, phrases, pieces, quality_rules, quotes, repair, sharding, vafile
from loghaven.llm.common import one_label
from loghaven.llm.sql import ORACLES as ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs, bare=True).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(quality_rules.with_text_stats(docs, prefix=quality_rules.PREFIX).drop("text"), "rule-stats")
    rules = quality_rules.rules_from(stats, one_label(table(spark, sf_dir, "labels"), "quality"))
    return quality_rules.judged(stats, rules)


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(gam.with_stats(docs).drop("text"), "model-stats")
    model = gam.learn(stats, one_label(table(spark, sf_dir, "labels"), "quality"))
    return gam.classified(stats, model)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).drop("text", "spans")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the number and a digest of its piece ids, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.round_trip(F.col("text"), pieces.load_pieces())
    rows = docs.withColumn("both", both).select("doc_id", "text", "both.ids", "both.decoded")
    whole = F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return rows.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == whole).alias("round_trip"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"), words=3, similarity=(90, 100))


def op7_quoted_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per message: what it replies to, its places, digests of its formatted text and of the piece
    of the conversation that it falls in."""
    rows = quotes.format_chats(table(spark, sf_dir, "conversations"))
    rows = stored(rows.select("conv_id", "turn", "role", "reply_to", "n_quoted", "n_linked", "position", "reply_position", "formatted", "piece"), "chats")
    pieces_of = quotes.chat_texts(rows).select(
        F.col("conv_id").alias("__conv"), F.col("piece").alias("__piece"), F.crc32(F.col("text").cast("binary")).alias("piece_crc32")
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("piece") == F.col("__piece"))
    return rows.join(pieces_of, same, "left").select(
        "conv_id", "turn", "role", "reply_to", "n_quoted", "n_linked", "position", F.crc32(F.col("formatted").cast("binary")).alias("formatted_crc32"),
        "reply_position", "piece", "piece_crc32",
    )


def op8_vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.vector_classes(table(spark, sf_dir, "embeddings"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_repaired_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    return repair.repair_summaries(repair.damaged(chats), chats)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_model": op3_quality_model,
    "op4_license_scan": op4_license_scan,
    "op5_pieces": op5_pieces,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quoted_chats": op7_quoted_chats,
    "op8_vector_classes": op8_vector_classes,
    "op9_lm_scores": op9_lm_scores,
    "op10_shards": op10_shards,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_collocations": op12_collocations,
    "op13_repaired_chats": op13_repaired_chats,
    "pipeline": pipeline,
}
