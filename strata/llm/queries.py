"""One query per numbered operator: the operator applied, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, decontaminate, jaccard, langid, secrets, simhash, spelling, token_counts,
               toxicity, urls, warc)
from .tables import held_out, table

#: Fixed names of the tokenizer package's rank file for operators 4 and 9.
RANK_FILE = "byte_bpe_50k.tiktoken"


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by shared 3-word shingles, nine tenths or more."""
    made = jaccard.groups(table(spark, sf_dir, "documents"), width=3, num=9, den=10)
    return made.select("doc_id", "n_shingles", "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text; trained without the held-out rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    made = toxicity.judge(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return made.drop("text")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every text."""
    import public_tokenizers
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
                                     public_tokenizers.PATTERN)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how near they are."""
    return simhash.with_near(simhash.compare(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets of every text."""
    docs = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(secrets.BASE))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size("secrets") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in secrets.BASE]
    return docs.select("doc_id", *counts, F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                       secrets.joined(F.col("secrets")).alias("spans"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside every document."""
    made = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return made.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes that they decode to, as digests."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.encode(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every text; fitted without the held-out rows."""
    docs = table(spark, sf_dir, "documents")
    fitted = langid.fit(docs.where(~held_out()))
    made = langid.identify(docs.select("doc_id", held_out().alias("held_out"), "text"), fitted)
    return made.drop("text")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, the words near them, and the forms that they are variants of."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), drop_every=31)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    folder = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language."""
    made = collocations.collocations(table(spark, sf_dir, "documents"))
    return made.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_jaccard": op2_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_chat": op6_chat,
    "op7_secrets": op7_secrets,
    "op8_decontaminate": op8_decontaminate,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_urls": op10_urls,
    "op11_spelling": op11_spelling,
    "op12_warc": op12_warc,
    "op13_collocations": op13_collocations,
}
