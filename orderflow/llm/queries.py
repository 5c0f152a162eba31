"""One query per operator, over its whole table with production parameters, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    blob_ledger, decontaminate, fuse_dedup, gam, hashtree, langid, mixing, preference, simhash_tiles, spelling, token_ans,
    toxicity, whitening,
)
from orderflow.llm.common import table

#: Folds of the classifiers' labels: one in this many is held out.
QUALITY_FOLDS = 5
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 3, 1


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of fold 0 are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = gam.fold(F.col("doc_id"), QUALITY_FOLDS) == 0
    model = gam.fit_quality(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return gam.score_texts(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= gam.THRESHOLD).cast("int").alias("predicted"))


def op2_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document; documents are the paths, their texts the blobs, and the ledger starts empty."""
    findings, _ = blob_ledger.scan(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    return blob_ledger.digest(findings)


def op3_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of fold 2 are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = gam.fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD_OUT
    grammar = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return toxicity.score_texts(docs, grammar).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and grown shard of every document (law ``key``, eight shards)."""
    return hashtree.assignment(table(spark, sf_dir, "documents"))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation, paired with its sibling."""
    return preference.format_sides(preference.sibling_sides(table(spark, sf_dir, "conversations")))


def op6_fuse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all documents: half of the ids, by hash, are the snapshot, the others the new batch."""
    docs = table(spark, sf_dir, "documents")
    return fuse_dedup.deduplicate(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1).drop("incoming")


def op7_token_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the written blocks."""
    return token_ans.encoded_documents(table(spark, sf_dir, "documents"))


def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    return simhash_tiles.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document (150 % of all words, 2 copies at most)."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that a document contains (5-word shingles, 0.8 of them)."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their neighbours, forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding (at most 32)."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of fold 1 are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = gam.fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    found = langid.identify(docs, langid.fit_languages(docs, learn=~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_blob_ledger": op2_blob_ledger,
    "op3_toxic_grammar": op3_toxic_grammar,
    "op4_hash_tree": op4_hash_tree,
    "op5_preference": op5_preference,
    "op6_fuse_dedup": op6_fuse_dedup,
    "op7_token_ans": op7_token_ans,
    "op8_simhash_tiles": op8_simhash_tiles,
    "op9_entropy_mix": op9_entropy_mix,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_trie": op11_spelling_trie,
    "op12_chebyshev_whitening": op12_chebyshev_whitening,
    "op13_byte_network": op13_byte_network,
}
ORACLE_SQL: dict[str, str] = {
    "op2_blob_ledger": blob_ledger.ORACLE_SQL,
    "op4_hash_tree": hashtree.ORACLE_SQL,
    "op5_preference": preference.ORACLE_SQL,
    "op6_fuse_dedup": fuse_dedup.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
    "op11_spelling_trie": spelling.ORACLE_SQL,
}
