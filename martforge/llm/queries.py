"""Registered queries of the subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import audit, bpe, decontaminate, fingerprints, lines, lm, pii, quality, ranked, simhash, tool_calls, vptree, wrappers
from martforge.llm.common import read

#: The tokenizer file of op6 and of the pipeline's last stage.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op4_quality_fm(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return quality.score(docs, quality.train(docs, read(spark, d, "labels")))


def op5_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(read(spark, d, "documents"))


def op6_bpe_codec(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(read(spark, d, "documents"), tokenizer_path(), keep_ids=False)


def op1_vantage_point_trees(spark: SparkSession, d: str) -> DataFrame:
    return vptree.nearest(read(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    return tool_calls.link_tool_calls(*tool_calls.calls_of(read(spark, d, "conversations")), tool_calls.SCHEMAS)


def op3_simhash_pivots(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, d, "documents"), words=3, max_bits=2)


def op7_log_frequency_lm(spark: SparkSession, d: str) -> DataFrame:
    return lm.score(read(spark, d, "documents"))


def op8_html_wrappers(spark: SparkSession, d: str) -> DataFrame:
    return wrappers.extract(read(spark, d, "pages"))


def op9_fuzzy_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.line_report(read(spark, d, "documents"))


def op10_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.leaks(read(spark, d, "documents"), read(spark, d, "benchmark"))


def op11_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_filters(read(spark, d, "documents"), read(spark, d, "labels"))


def op12_bottom_k(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read(spark, d, "documents"))


def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked.search(read(spark, d, "documents"), read(spark, d, "benchmark"))


QUERIES = {
    "op1_vantage_point_trees": op1_vantage_point_trees,
    "op2_tool_calls": op2_tool_calls,
    "op3_simhash_pivots": op3_simhash_pivots,
    "op4_quality_fm": op4_quality_fm,
    "op5_pii": op5_pii,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_log_frequency_lm": op7_log_frequency_lm,
    "op8_html_wrappers": op8_html_wrappers,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_bottom_k": op12_bottom_k,
    "op13_ranked_search": op13_ranked_search,
}
