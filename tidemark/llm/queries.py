"""One registered query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, fingerprint, language, lines, minhash, packing, phrases, preferences, quality, sharding, surrogates, toxicity, variants
from tidemark.llm.oracles import ORACLES

#: Key of the surrogates in the registered query; a job brings its own secret.
SURROGATE_KEY = "registered-query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """The remainder of the checksum of doc_id as text that sets rows aside."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(_table(spark, sf_dir, "documents"))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen; rejected is the same one with the last assistant turn's text
    taken from the next conv_id's last assistant turn, or without that turn where there is none."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = turns.where((F.col("role") == preferences.TRAINED_ROLE) & F.col("turn").isNotNull())
    last = said.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last").alias("other"))
    swapped = F.coalesce((F.col("role") == preferences.TRAINED_ROLE) & (F.col("turn") == F.col("last.turn")), F.lit(False))
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text"), F.lit(True).alias("said")),
        F.struct(
            F.lit("rejected").alias("side"),
            F.when(swapped, F.col("other.text")).otherwise(F.col("text")).alias("text"),
            (~swapped | F.col("other").isNotNull()).alias("said"),
        ),
    )
    sided = (
        turns.join(last, "conv_id", "left")
        .join(other, "conv_id", "left")
        .select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("of"))
        .where("of.said")
        .select("pair_id", "of.side", "turn", "role", "of.text")
    )
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["begin"], F.lit("-"), s["end"])), ",").alias(c)
    return preferences.pairs(sided).select(
        "pair_id", F.col("n_common").cast("long").alias("n_common"), "prompt", "chosen", "rejected", spans("chosen_mask"), spans("rejected_mask")
    )


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score and predicted; rows of the held-out fold teach nothing."""
    known = labels.where(fold(5) != 0).select("doc_id", F.col("quality").alias("label"))
    weights = quality.fit(docs, known)
    return quality.score(docs, weights).withColumns(
        {"held_out": fold(5) == 0, "predicted": (F.col("score") >= quality.REJECT_BELOW).cast("int")}
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed lines of every document, as text."""
    found = lines.summary(_table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(_table(spark, sf_dir, "documents"), 2)


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs, SURROGATE_KEY)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, chances = language.fit(docs.where(fold(4) != 2))
    found = language.predict(docs.select("doc_id", "text"), names, chances)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the held-out fold teach nothing."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    known = _table(spark, sf_dir, "labels").where(fold(5) != 0).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.fit(docs, known))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprint,
        op2_preferences,
        op3_quality,
        op4_packing,
        op5_lines,
        op6_minhash,
        op7_surrogates,
        op8_decontamination,
        op9_language,
        op10_sharding,
        op11_phrases,
        op12_toxicity,
        op13_variants,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
