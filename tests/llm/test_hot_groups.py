"""Equal rows in sharding, and a cache of token counts that lasts."""

from collections import Counter
from hashlib import sha256

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from strata.llm import sharding, token_counts
from strata.llm.queries import MODEL, QUERIES
from strata.session import work_folder
from tests.conftest import SMALL
from tests.llm.test_llm import DOCS, documents, small


def test_equal_rows_go_over_many_tasks(spark, monkeypatch):
    """20 000 equal rows among 600 others: slots without gaps, and no task with most of them."""
    same = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(8).cast("long").alias("n_chars"))
    docs = same.unionByName(documents(spark, [f"t {i}" for i in range(600)]))
    tasks, plain = [], sharding.settled
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def watched(rows, purpose):
        out = plain(rows, purpose)
        if purpose == "curve-tasks":
            tasks.extend(r[1] for r in out.collect())
        return out

    monkeypatch.setattr(sharding, "settled", watched)
    try:
        placed = sharding.placements(docs, 24).select("shard", "slot").collect()
        moved = sharding.sharded(docs, 24).select("shard", "slot").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for rows in (placed, moved):
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert sorted(slots) == list(range(24)) and {len(x) for x in slots.values()} <= {858, 859}
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sum(tasks) == 2 * 20_600 and max(tasks) < 10_000


def test_runs_of_the_curve_can_be_skipped(spark):
    """Files of a shard hold few languages and sources, two thirds at most of those of shards dealt by chance."""
    rows = sharding.sharded(small(spark), 24)
    held = rows.groupBy("shard").agg(F.countDistinct("lang", "source").alias("names"))
    dealt = small(spark).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(24))).groupBy("shard").agg(F.countDistinct("lang", "source").alias("names"))
    assert held.agg(F.sum("names")).first()[0] * 1.5 < dealt.agg(F.sum("names")).first()[0]


def test_a_lasting_cache(spark):
    with open(public_tokenizers.path(MODEL), "rb") as file:
        model = file.read()
    library, folder = sentencepiece.SentencePieceProcessor(model_proto=model), work_folder(spark, "lasting")
    first = token_counts.token_counts(documents(spark, ["a b", "a b", "c", None]), folder, model).collect()
    assert not any(r["cached"] for r in first)
    again = {r["doc_id"]: r for r in token_counts.token_counts(documents(spark, ["c", "", "d e f", "a b"]), folder, model).collect()}
    assert [again[i]["cached"] for i in range(4)] == [True, True, False, True]
    assert [again[i]["n_tokens"] for i in range(4)] == [len(library.encode(t)) for t in ("c", "", "d e f", "a b")]
    batches = Counter(r["batch"] for r in spark.read.parquet(f"{folder}/tokenizer=*").collect())
    assert sorted(batches.values()) == [1, 3]
    # Another tokenizer has counts of its own: what this one knows is no hit.
    assert token_counts.tokenizer_version(model) != token_counts.tokenizer_version(model + b" ")


def test_the_query_meets_hits_and_misses(spark):
    found = {r["doc_id"]: r["cached"] for r in QUERIES["op2_token_counts"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] for r in small(spark).collect()}
    assert found == {i: sha256((t or "").encode()).hexdigest()[0] == "0" for i, t in texts.items()}
    assert 0 < sum(found.values()) < len(found)


def test_names_of_working_columns_are_free(spark):
    odd = spark.createDataFrame([(1, "a", "en", "s", 0, 5, 6)], DOCS + ", _n long, _place long")
    out = sharding.sharded(odd, 3)
    assert set(odd.columns) < set(out.columns) and out.first()["_place"] == 6
    assert sharding.sharded(odd.limit(0), 3).count() == 0
