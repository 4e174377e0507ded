"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideglass.llm import bpe
from tideglass.llm.backoff import score_documents
from tideglass.llm.credentials import KINDS, find_secrets
from tideglass.llm.extraction import extract_text
from tideglass.llm.langid import identify
from tideglass.llm.maxscore import top_k
from tideglass.llm.mixing import mix_sources
from tideglass.llm.neardup import near_duplicates
from tideglass.llm.phrases import collocations
from tideglass.llm.pivots import nearest
from tideglass.llm.quality import quality_rules
from tideglass.llm.repair import damage, plan_repairs, repaired_turns, transcript_digests
from tideglass.llm.shipping import ship
from tideglass.llm.tokenfiles import read_token_files, write_token_files
from tideglass.sources.workspace import fresh_folder, stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = "embedding is not null and not exists(embedding, " \
        "x -> x is null or isnan(x) or abs(x) = double('inf'))"
    vectors = _table(spark, sf_dir, "embeddings").where(usable).select("vec_id", F.transform(
        "embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vec"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_lm_scores_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word of context, as the query's SQL has it."""
    return score_documents(_table(spark, sf_dir, "documents"), order=2)


def op3_quality_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(quality_rules(_table(spark, sf_dir, "documents")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older verdicts, as the query's SQL has them."""
    return _verdicts(quality_rules(_table(spark, sf_dir, "documents"), floors=True))


def _verdicts(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder,
                      public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, folder)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op6_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def _joined(spans: str) -> Column:
    return F.expr(f"concat_ws(',', transform({spans}, "
                  "s -> concat_ws(':', s.kind, string(s.start), string(s.end))))")


def op7_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.expr(f"filter(spans, s -> s.kind != '{KINDS[3]}')")
    found = find_secrets(_table(spark, sf_dir, "documents")).withColumn("base", base)
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}")
          for k in KINDS[:3]],
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    damaged = damage(given)
    repairs = stage(plan_repairs(damaged), "planned-repairs")
    digests = transcript_digests(repaired_turns(damaged, repairs))
    every = given.select(F.col("conv_id").alias("id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(repairs, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(
        digests, F.col("id").eqNullSafe(F.col("conv")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: f for name, f in list(globals().items()) if name.startswith("op")
}
