"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (bpe, chat_format, decontaminate, html_text, lexical_index, license_scan, line_dedup, ngram_join,
                          pii, quality_model, quality_rules, vector_codes, warc)
from lakemart.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_spans(_table(spark, sf_dir, "documents")).drop("redacted")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the line-first verdict for every document."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"), k=3, threshold=(90, 100))


def tokenizer() -> tuple[bytes, str]:
    """The rank file's contents and the splitting pattern."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and their decoding."""
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), *tokenizer(), keep_ids=False)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from labels outside the held-out third."""
    docs = _table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the words where it stands."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    folder = scratch_dir(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder, payloads=False).drop("url")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later repeated runs of lines."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, encoded and masked, then read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", fixed), (-7, 1, "assistant", fixed)], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.unionAll(more), *tokenizer()))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    index = lexical_index.build_index(_table(spark, sf_dir, "documents"))
    return lexical_index.search(index, _table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts for every vector, with their errors and the codebooks' hash."""
    codes = vector_codes.encode_vectors(_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes.rows).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codes.books_sha256()).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_html_text": op2_html_text,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_join": op4_ngram_join,
    "op5_bpe": op5_bpe,
    "op6_quality_model": op6_quality_model,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = {
    "op4_ngram_join": ngram_join.oracle_sql(),
    "op8_warc": warc.oracle_sql(),
    "op11_chat_format": chat_format.oracle_sql(),
    "op12_lexical_search": lexical_index.oracle_sql(),
    "op13_vector_codes": vector_codes.oracle_sql(),
}
