"""The operators as queries over the given tables, each with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltscape.llm import (
    chat,
    decontaminate,
    divergence,
    language,
    licenses,
    mixing,
    pii,
    prefix_trie,
    quality_knn,
    quality_rules,
    repeats,
    simhash,
    warc,
)
from voltscape.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.planned(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    return planned.selectExpr(
        "doc_id", "source", "size", "source_size", "target", "copies", "copies * size as taken"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return captures.selectExpr(
        "cast(page_id as bigint) as page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "cast(refers_to as bigint) as refers_to",
        "url_key",
        "timestamp",
        "place",
    )


def op3_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_knn.predictions(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    # examples come out placed by conversation, so they are read back where they are made
    return chat.digests(chat.examples(turns.union(extra)))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", "item_id", "score", "part_score", "start", "end", "n_seeds", "sha2(passage, 256) as passage_sha256")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr(
        "doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) as kept_sha256",
        "repeated", "n_groups", "longest_group", "occurrences",
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.known_licenses(spark))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "lang", "source", *quality_rules.COUNTS, "base_failed", "d2", "kept")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = "array('email', 'ip', 'card', 'phone', 'term')"

    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', {kinds}[s.kind], s.start, s.end)), ',')"

    terms = "transform(terms, s -> struct(s.start, s.end, 4 as kind))"
    order = "(a, b) -> case when a.start <> b.start then a.start - b.start when a.kind <> b.kind then a.kind - b.kind else a.end - b.end end"
    return found.selectExpr(
        "doc_id",
        *(f"cast(size(filter(base, s -> s.kind = {i})) as bigint) as n_{kind}" for i, kind in enumerate(pii.KINDS)),
        f"sha2({listed('base')}, 256) as base_sha256",
        f"{listed(f'array_sort(concat(base, {terms}), {order})')} as spans",
    )


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.predictions(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_warc,
        op3_quality_knn,
        op4_simhash,
        op5_chat,
        op6_decontaminate,
        op7_repeats,
        op8_licenses,
        op9_quality_rules,
        op10_personal_data,
        op11_language,
        op12_prefix_trie,
        op13_divergence,
    )
}
