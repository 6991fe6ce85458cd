"""The stages of the corpus pipeline: each takes ``(spark, docs, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, jaccard, langid, secrets
from .queries import RANK_FILE
from .tables import held_out, table


def _own(docs: DataFrame) -> DataFrame:
    """``docs`` with every column prefixed, so that none is named like an operator's."""
    return docs.toDF(*[f"_own_{c}" for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with their columns as they were."""
    fitted = langid.fit(docs.where(~held_out()))
    kept = langid.identify(_own(docs), fitted, "_own_text").where(~F.col("rejected"))
    return kept.select(*[F.col(f"`_own_{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, 0.8 or more."""
    return jaccard.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    judged = decontaminate.judge(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = judged.where("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    same = F.col("_own_doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("_own_text") == F.col("_bad_text"))
    own = _own(docs).join(bad, same, "left_anti")
    return own.select(*[F.col(f"`_own_{c}`").alias(c) for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    found = secrets.scan(_own(docs), "_own_text")
    new = {"text": F.coalesce("clean", "_own_text"),
           "n_chars": F.coalesce(F.length("clean").cast("long"), "_own_n_chars")}
    return found.select(*[new.get(c, F.col(f"`_own_{c}`")).alias(c) for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document, with the digests of op9."""
    import public_tokenizers
    return bpe.encode(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
