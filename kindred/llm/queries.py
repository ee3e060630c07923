"""The registered queries of the training-data operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    binary_packing,
    centroid_clusters,
    decontaminate,
    host_reputation,
    jaccard_join,
    line_templates,
    mixing,
    quality_forest,
    rans_tokens,
    token_rollups,
    toxicity_fm,
    turn_repair,
    warc_store,
)
from kindred.sources.staging import staged_path

# The rules of the URL query.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TOKENIZER = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def op2_source_mix(spark, sf_dir):
    """Words that the mix takes of each document."""
    return mixing.mixture(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def op3_line_templates(spark, sf_dir):
    """Lines of each document, those dropped, and a digest of the text that is left."""
    return line_templates.without_recurring_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.md5("text").alias("text_md5")
    )


def op4_warc_store(spark, sf_dir):
    """Pages written to the archive and read back."""
    path = staged_path(spark, "warc")
    warc_store.write_archive(read(spark, sf_dir, "pages"), path)
    return warc_store.read_archive(spark, path, with_payload=False).drop("header")


def op5_quality_forest(spark, sf_dir):
    """Rule statistics and verdict of each document."""
    return quality_forest.filtered(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op6_rans_tokens(spark, sf_dir):
    """Documents written as token blocks and read back."""
    path = staged_path(spark, "tokens")
    rans_tokens.write_tokens(read(spark, sf_dir, "documents"), path, tokenizer_path())
    return rans_tokens.read_tokens(spark, path, with_ids=False)


def op7_toxicity_fm(spark, sf_dir):
    """Toxicity score of each document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_fm.toxicity(documents, read(spark, sf_dir, "labels")).select(
        "doc_id",
        toxicity_fm.held_out("doc_id").alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op8_host_reputation(spark, sf_dir):
    """Verdict on each page's url."""
    return host_reputation.judged(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), URL_RULES).drop("bound")


def op9_token_rollups(spark, sf_dir):
    """Totals after four batches over all documents: all inserted as words; those of fewer than 20
    words deleted; all counted anew by letters and digits as a second version, the first one revised to count
without words of one character; the third batch once more.  Documents without an id are only inserted."""
    path = staged_path(spark, "rollups")
    documents = read(spark, sf_dir, "documents")
    words = mixing.word_count("text")
    base = documents.select("doc_id", "source", "lang", "text", F.lit(1).alias("seq"))
    first = base.select("doc_id", "source", "lang", "seq", F.lit("words-1").alias("version"), words.alias("tokens"), F.lit("insert").alias("op"))
    pieces = F.greatest(F.size(F.split(F.concat(F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" ")), "[^A-Za-z0-9]+")) - 2, F.lit(0))
    second = base.select("doc_id", "source", "lang", "seq", F.lit("pieces-1").alias("version"), pieces.alias("tokens"), F.lit("insert").alias("op"))
    short = first.where("tokens < 20").withColumn("op", F.lit("delete"))
    revised = first.where("doc_id is not null and tokens >= 20").withColumns({"tokens": F.col("tokens") - 1, "op": F.lit("revise")})
    token_rollups.commit_batch(first, path, 1)
    token_rollups.commit_batch(short, path, 2)
    token_rollups.commit_batch(second.unionByName(revised), path, 3)
    token_rollups.commit_batch(short, path, 2)
    return token_rollups.totals(spark, path)


def op10_decontaminate(spark, sf_dir):
    """Documents that leak benchmark items, with the similarity of the best window."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("similarity", 6).alias("similarity")
    )


def op11_centroid_clusters(spark, sf_dir):
    """Cluster, distance and inertia of each vector."""
    return centroid_clusters.clusters(read(spark, sf_dir, "embeddings"))[0]


def op12_binary_packing(spark, sf_dir):
    """Pieces of all documents, packed and read back."""
    path = staged_path(spark, "packed")
    binary_packing.write_packed(read(spark, sf_dir, "documents"), path, tokenizer_path())
    return binary_packing.read_packed(spark, path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op13_turn_repair(spark, sf_dir):
    """Faults, cheapest edits and digest of the repaired text of each conversation."""
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, turns = turn_repair.repaired(conversations, turn_repair.damaged(conversations))
    digest = turn_repair.digests(turns).withColumnRenamed("conv_id", "id")
    return report.join(digest, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        *report.columns, F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )


REGISTERED: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_jaccard_join, op2_source_mix, op3_line_templates, op4_warc_store, op5_quality_forest,
    op6_rans_tokens, op7_toxicity_fm, op8_host_reputation, op9_token_rollups, op10_decontaminate,
    op11_centroid_clusters, op12_binary_packing, op13_turn_repair,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in REGISTERED}
