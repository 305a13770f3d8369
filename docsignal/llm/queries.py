"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.llm import chat, exact, fingerprints, jaccard, langid, licences, packing, periodic, pieces, rules, search, suffixes, warc
from docsignal.llm.common import read


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_summary(warc.archive_pages(read(spark, sf_dir, "pages")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = rules.judge(read(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.encode(read(spark, sf_dir, "documents"), model, back=True)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_byte_ids", "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"), pieces.restored().alias("restored"),
    )


#: A conversation of control strings that every run formats beside the table.
ADVERSARIAL = [
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(ADVERSARIAL, "conv_id long, turn long, role string, text string")
    tokens = public_tokenizers.path("byte_bpe_50k.tiktoken")
    stream, index = chat.format_conversations(turns.union(extra), tokens)
    return chat.read_back(stream, index, tokens)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "langs", "proportions"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return packed.drop("ids")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_corpus(read(spark, sf_dir, "documents"))
    known = F.filter("spans", lambda s: s["family"] != licences.UNKNOWN)
    families = F.array_sort(F.array_distinct(F.transform(known, lambda s: s["family"])))
    return found.select(
        "doc_id", families.alias("families"), F.size("spans").cast("long").alias("n_spans"),
        F.size(known).cast("long").alias("n_confirmed"), "spans",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.planted(read(spark, sf_dir, "documents"))
    return periodic.digests(periodic.find_runs(docs))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_edited(read(spark, sf_dir, "documents"))
    return found.withColumns(
        {c: fingerprints.hexadecimal(c) for c in ("fingerprint", "edited_fingerprint")}
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.index_documents(read(spark, sf_dir, "documents"))
    return search.search(index, read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard": op3_jaccard,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_chat": op5_chat,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_packing": op8_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_licences": op10_licences,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_fingerprints": op12_fingerprints,
    "op13_ranked_search": op13_ranked_search,
}
