"""Registered queries of this folder and the SQL they are checked with."""

from __future__ import annotations

__all__ = ["QUERIES", "SQL"]

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import chat, contamination, licenses, line_dedup, mixing, near_dups, pii, prefix_trie, quality, sharding, structure_repair, token_counts, warc
from strata.llm.oracle import SQL
from strata.llm.shared import table
from strata.session import work_folder

MODEL = "piece_bpe_32k.model"
SHARDS = 24


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10)

    def digests(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            lines, dropped, digest = [], [], []
            for text, bitmap in zip(batch.column("text"), batch.column("bitmap"), strict=True):
                n, kept = line_dedup.kept_lines(text.as_py(), bitmap.as_py())
                lines.append(n)
                dropped.append(n - len(kept))
                digest.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest)],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    return line_dedup.with_bitmaps(docs, bitmaps, "doc_id", "text").mapInArrow(digests, schema)


def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, over a cache that an earlier run over a sixteenth of the contents has filled."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    with open(public_tokenizers.path(MODEL), "rb") as file:
        model = file.read()
    cache = work_folder(spark, "token-cache")
    token_counts.extend_cache(token_counts.share_of_contents(docs), cache, model)
    return token_counts.token_counts(docs, cache, model)


def near_dups_query(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_dups.NearDuplicates(table(spark, folder, "documents"), size=3, percent=85).groups()
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.schedule(table(spark, folder, "documents"), mixing.Goal())
    return plan.select("doc_id", "source", "tokens", F.round("weight", 6).alias("weight"), F.round("passes", 6).alias("passes"), "block", "place", "copies")


def contamination_query(spark: SparkSession, folder: str) -> DataFrame:
    found, n_words, hits, longest = contamination.matches(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    n_hit, items = contamination.hit_words(hits), contamination.matched_items(longest)
    return found.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        contamination.is_contaminated(F.col(n_words), n_hit).alias("contaminated"),
    )


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def sharding_query(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.placements(table(spark, folder, "documents"), SHARDS)


def pii_query(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def licenses_query(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_blocks(table(spark, folder, "documents")).select("doc_id", "place", "block", "license", "saved", "differences")


def chat_query(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rendered(table(spark, folder, "conversations"))


def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    pages, path = table(spark, folder, "pages").select("page_id", "url", "html"), work_folder(spark, "archives")
    warc.write_archives(pages, path)
    rows, kind = warc.read_archives(spark, path, payloads=False), pages.schema["page_id"].dataType
    return rows.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def prefix_trie_query(spark: SparkSession, folder: str) -> DataFrame:
    nodes = prefix_trie.trie(*prefix_trie.rebuilt(table(spark, folder, "conversations")))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def structure_repair_query(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return structure_repair.report(conversations, structure_repair.damaged(conversations))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup_query,
    "op2_token_counts": token_counts_query,
    "op3_near_dups": near_dups_query,
    "op4_mixing": mixing_query,
    "op5_contamination": contamination_query,
    "op6_quality": quality_query,
    "op7_sharding": sharding_query,
    "op8_pii": pii_query,
    "op9_licenses": licenses_query,
    "op10_chat": chat_query,
    "op11_warc": warc_query,
    "op12_prefix_trie": prefix_trie_query,
    "op13_structure_repair": structure_repair_query,
    "pipeline": pipeline,
}
