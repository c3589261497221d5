"""Registered queries of the training-data operators, and their DuckDB SQL where SQL expresses them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from surgewatch.llm import chat_format
from surgewatch.llm.common import let, table, words
from surgewatch.llm.conversation_repair import digest, repair
from surgewatch.llm.decontaminate import contaminated
from surgewatch.llm.html_extract import extract_text
from surgewatch.llm.katz import score_documents
from surgewatch.llm.langid import fit, held_out, predict
from surgewatch.llm.license_scan import scan_licenses
from surgewatch.llm.line_dedup import dedup_lines
from surgewatch.llm.packing import pack, pieces
from surgewatch.llm.periodic_runs import periodic_runs
from surgewatch.llm.quality_rules import apply_rules
from surgewatch.llm.simhash import simhash_groups
from surgewatch.llm.tokens import token_counts
from surgewatch.session import scratch_path


def tokenizer() -> tuple[str, str]:
    """The tokenizer's file, and the same vocabulary for the faster library."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of later copies of runs of 50 words or more: counts and checksum."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups of all documents (4-word shingles, 4 bits)."""
    return simhash_groups(table(spark, sf_dir, "documents"), k=4, bits=4).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token counts, found in flat files of the tokenized documents."""
    return token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "flat-files"), *tokenizer())


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with linked tool calls (stand-in calls: one per line of an assistant's message)."""
    messages = table(spark, sf_dir, "conversations")
    return chat_format.format_chats(messages, *chat_format.stand_in(messages), chat_format.SCHEMAS)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("text_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, re-parameterised ones included."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids packed into sequences of at most 1024."""
    return pack(pieces(table(spark, sf_dir, "documents"), *tokenizer(), size=1024), size=1024)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and risk-controlled rules over all documents."""
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a Katz bigram model of those that aren't held out."""
    return score_documents(table(spark, sf_dir, "documents"), order=2)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text; the texts of ids whose crc32 ends in 0 go on, from some word, as periodic ones."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def planted(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(
            w, lambda v, i: F.when(i < x["a"], v).otherwise(F.get(w, x["a"] + (i - x["a"]) % x["p"]))), " "))
    text = F.col("text").cast("string")
    changed = let(words(text), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(text).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, some of them planted: numbers, the longest run, checksums."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    first = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    own = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("x"), lines.alias("lines"), "collapsed")
    return own.select(
        "doc_id", "n_runs", F.col("x.s").alias("start"), (-F.col("x.l")).alias("length"), F.col("x.p").alias("period"),
        F.expr("(1000 * -x.l) div x.p").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat("lines", F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def damaged(messages: DataFrame) -> DataFrame:
    """Messages dropped, emptied, cut short, repeated or reroled by a hash of conversation and turn."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    own = messages.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return own.filter("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("_")).drop("_")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired: faults, cheapest edits, checksum of the repaired messages."""
    messages = table(spark, sf_dir, "conversations")
    found, repaired = repair(damaged(messages))
    ids = messages.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    same = lambda x: F.col("conv_id").eqNullSafe(F.col(x))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(found.withColumnRenamed("conv_id", "a"), same("a"), "left")
            .join(digest(repaired).withColumnRenamed("conv_id", "b"), same("b"), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash_dedup, op3_token_counts, op4_chat_format, op5_license_scan, op6_decontamination,
    op7_packing, op8_language_id, op9_html_extraction, op10_quality_rules,
    op11_lm_scoring, op12_periodic_runs, op13_conversation_repair)}

ORACLE: dict[str, str] = {}
