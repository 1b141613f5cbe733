"""One query per operator over its whole table. ``oracles`` has the same as SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import byte_bpe, conversations, divergence, licenses, lm_scores, ngram_join, packing, quality, sentence_pieces, style_tree, token_files, toxicity, vector_join

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs, files = table(spark, folder, "documents"), token_files.new_folder(spark)
    token_files.write(docs, files, WORD_BPE, end_id=2)
    by_key = token_files.fetch(docs, files, key_col="doc_id", payload=False)
    unnamed = token_files.read_places(token_files.read_entries(spark, files).where("key IS NULL"), files, payload=False)
    return by_key.unionByName(unnamed).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op2_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return sentence_pieces.encode(docs, PIECE_BPE, verify=True).drop("ids", "width")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan_licenses(table(spark, folder, "documents")))


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"), words=4, percent=85)


def op6_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.main_text(table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs.where(~toxicity.held_out()), table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", toxicity.held_out().alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_subspace_join(spark: SparkSession, folder: str) -> DataFrame:
    return vector_join.similar_vectors(table(spark, folder, "embeddings"), least=0.98)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, WORD_BPE, end_id=0)
    return packing.place(pieces.drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op10_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    scores = lm_scores.stupid_backoff(table(spark, folder, "documents"))
    return scores.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, folder, "documents"), BYTE_BPE, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, BYTE_BPE, public_tokenizers.PATTERN, keep_ids=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.Repair(conversations.damage(table(spark, folder, "conversations"))).report()


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_join": op5_ngram_join,
    "op6_site_style_tree": op6_site_style_tree,
    "op7_toxicity": op7_toxicity,
    "op8_subspace_join": op8_subspace_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_stupid_backoff": op10_stupid_backoff,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_source_divergence": op12_source_divergence,
    "op13_conversation_repair": op13_conversation_repair,
}
