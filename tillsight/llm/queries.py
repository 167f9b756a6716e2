"""The operators as registered queries over the given tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import bpe, centroids, chat, decontam, langid, lines, merkle, mixing, pii, quality, sharding, simhash, topk
from tillsight.llm.common import crc32_of, staged, utf8_bytes

SHARDS = 24
NEIGHBOURS = 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate_lines(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    thin = _table(spark, sf_dir, "documents").select(
        "doc_id", (utf8_bytes(text) + 8).alias("__size"), crc32_of(text).alias("text_crc32"), sharding.group_key(text).alias("__key")
    )
    thin = staged(thin, "shard-rows")  # the texts are read once
    cuts, _ = sharding.minimax_cuts(sharding.group_sizes(thin), SHARDS)
    placed = sharding.with_slots(thin, sharding.shard_of(F.col("__key"), cuts).cast("int"))
    return placed.select(
        "doc_id", F.col("__size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "topic", F.col("__tokens").alias("tokens"), F.col("__p").alias("probability"), F.col("__sampled").alias("sampled")
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    weights = quality.classifier(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), quality.score_column(spark, weights, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql(
        """SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
           FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"""
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = chat.format_chats(turns).withColumn("back", chat.read_back(F.col("formatted")))
    told = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.masked_text(F.col("formatted"), F.col("loss_mask"))
    return chats.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), pii.all_spans(F.col("base"), F.col("terms")).alias("spans")
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, NEIGHBOURS)


def op9_language_id(spark: SparkSession, sf_dir: str, pieces_path: str = langid.VOCABULARY) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))), pieces_path=pieces_path)
    held = langid.held_out(F.col("doc_id")).alias("held_out")
    found = langid.predict_column(spark, model, F.col("text"))
    return docs.select("doc_id", held, found.alias("found")).select("doc_id", "held_out", "found.lang_pred", "found.score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(_table(spark, sf_dir, "documents"))
    found = decontam.find_matches(index, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size(F.array_except("near_item_ids", "item_ids")).cast("long").alias("n_near_items"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {c: F.col(c) for c in merkle.FIELDS}
    lower = fields | {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = merkle.leaf(*fields.values())
    rows = _table(spark, sf_dir, "documents").select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, merkle.leaf(*lower.values())).alias("claimed"))
    manifest = merkle.build_manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "claimed"])
    return merkle.proofs(manifest, "claimed").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster_vectors(_table(spark, sf_dir, "embeddings")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: tuple[bytes, str] | None = None) -> DataFrame:
    coded = bpe.encode_texts(_table(spark, sf_dir, "documents"), vocabulary=vocabulary, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (
        op1_line_dedup, op2_sharding, op3_mixing, op4_quality_classifier, op5_simhash_near_dedup, op6_chat_formatting,
        op7_pii, op8_exact_topk, op9_language_id, op10_decontamination,
        op11_merkle_manifest, op12_centroid_clustering, op13_byte_bpe,
    )
    return {q.__name__: q for q in own} | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    from tillsight.llm.oracles import ORACLES

    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
