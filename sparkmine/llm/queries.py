"""Registered queries of this package: each applies its operator, with the
parameters of production, to its whole table and returns the whole result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkmine.llm import chat, credentials, decontaminate, language, lexical, licenses, mixing, pages, quality, runs, simhash, sql, substrings, tokens
from sparkmine.llm.tables import prepare, table
from sparkmine.plans.workspace import materialize, new_path

TOKENIZER = "word_bpe_49k.json"


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(prepare(spark), sf_dir, "documents"))


def token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(prepare(spark), "tokens")
    shards = tokens.write(table(spark, sf_dir, "documents"), root, public_tokenizers.path(TOKENIZER))
    return tokens.read(shards, root)


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(prepare(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-1, 0, "user", sql.CONTROL), (-1, 1, "assistant", sql.CONTROL)]
    turns = turns.union(spark.createDataFrame(control, "conv_id long, turn long, role string, text string"))
    formatted = materialize(chat.format_trees(chat.as_replies(turns, "conv_id")), "chat")
    found = chat.digests(formatted)
    return found.select(found["tree"].cast("long").alias("conv_id"), *found.columns[1:])


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(found["fp"]).alias("fingerprint"), "component_id")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.clean(table(prepare(spark), sf_dir, "documents"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(prepare(spark), sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(prepare(spark), sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(prepare(spark), sf_dir, "documents"))


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, one row for each item that one holds."""
    prepare(spark)
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digests(credentials.find(table(prepare(spark), sf_dir, "documents")))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, about one in ten of them with a planted periodic tail."""
    docs = table(prepare(spark), sf_dir, "documents")
    return runs.digests(runs.find(docs.select("doc_id", runs.plant(docs["doc_id"], docs["text"]).alias("text"))))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan,
    "op2_token_shards": token_shards,
    "op3_chat_format": chat_format,
    "op4_simhash_classes": simhash_classes,
    "op5_language_id": language_id,
    "op6_substring_dedup": substring_dedup,
    "op7_mix_sources": mix_sources,
    "op8_page_text": page_text,
    "op9_quality_rules": quality_rules,
    "op10_contaminated": contaminated,
    "op11_secret_scan": secret_scan,
    "op12_periodic_runs": periodic_runs,
    "op13_ranked_search": ranked_search,
}
SQL: dict[str, str] = {
    "op1_license_scan": sql.LICENSE_SCAN,
    "op3_chat_format": sql.CHAT,
    "op6_substring_dedup": sql.SUBSTRING_DEDUP,
    "op9_quality_rules": sql.QUALITY_RULES,
    "op13_ranked_search": sql.RANKED_SEARCH,
}
