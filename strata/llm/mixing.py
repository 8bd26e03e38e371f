"""Mixing sources to target weights by temperature.

The token share of each source is raised to an exponent and normalised. The
exponent is the smallest one, found by bisection, whose mixture is no more even
than a target entropy and repeats no source more than a limit times as often as
any other. The token budget is the least that still takes every document once,
so nothing is dropped. Each source is then realised as a permutation: its
documents are dealt into blocks by digest, blocks and documents ordered by digest,
full passes repeated, and the remaining budget filled from the front. Running
sums go over blocks first and inside one block after, and blocks are bounded by
tokens and by documents, so a source with a third of all rows is spread like any
other, without a single token too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.shared import WORD, free_names, identity, marked, part_by_digest
from strata.session import settled

#: Tokens and documents of a block, about.
BLOCK_TOKENS = 1_000_000
BLOCK_ROWS = 16_384
#: Bisection steps that one job takes together, and jobs.
STEPS, ROUNDS = 5, 5


@dataclass(frozen=True)
class Goal:
    """Entropy as a share of the largest possible one, and the most passes over a source."""

    entropy: float = 0.95
    passes: float = 4.0


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponent(sources: DataFrame, goal: Goal) -> float:
    """The smallest exponent that meets the goal, on a grid of 2**-25.

    ``sources`` has ``tokens``, one positive row per source. Entropy and
    repetition both fall as the exponent grows to 1, where the mixture is the
    corpus itself. A corpus that is more even than the goal stays as it is.
    """
    total = sources.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total[0] or total[1] < 2:
        return 1.0
    target = goal.entropy * math.log(total[1])
    share = F.log(F.col("tokens") / F.lit(total[0]))

    def meets(points: list[float]) -> list[bool]:
        raised = sources.select(share.alias("l"), F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("a"))
        rows = (
            raised.groupBy("a")
            .agg(F.sum(F.exp(F.col("a") * F.col("l"))).alias("z"), F.sum(F.exp(F.col("a") * F.col("l")) * F.col("l")).alias("zl"), F.min("l").alias("low"), F.max("l").alias("high"))
            .collect()
        )  # one row per point
        found = {}
        for row in rows:
            entropy = math.log(row["z"]) - row["a"] * row["zl"] / row["z"]
            uneven = abs(row["a"] - 1) * (row["high"] - row["low"])
            found[row["a"]] = entropy <= target + 1e-9 and uneven <= math.log(goal.passes) + 1e-12
        return [found[float(p)] for p in points]

    even, same = meets([0.0, 1.0])
    if even or not same:
        return 0.0 if even else 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * k / 2**STEPS for k in range(1, 2**STEPS)]
        answers = meets(points)
        first = answers.index(True) if True in answers else len(points)
        low, high = (points[first - 1] if first else low), (points[first] if first < len(points) else high)
    return high


def weights(docs: DataFrame, goal: Goal, source: str, tokens: str) -> tuple[DataFrame, float]:
    """(source key, tokens, documents, weight, passes) per source, and the exponent.

    ``passes`` is the budget of a source over its tokens, from 1 on. A source
    without any tokens has weight 0 and one pass.
    """
    sums = settled(docs.groupBy(source).agg(F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("documents")), "source-tokens")
    power = exponent(sums.filter("tokens > 0").select("tokens"), goal)
    total = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    raised = F.when(F.col("tokens") > 0, F.exp(power * F.log(F.col("tokens") / F.lit(max(total, 1))))).otherwise(0.0)
    figures = sums.select(source, "tokens", "documents", raised.alias("raised"))
    sums = figures.agg(F.coalesce(F.sum("raised"), F.lit(1.0)).alias("z"), F.coalesce(F.min(F.when(F.col("tokens") > 0, F.col("raised") / F.col("tokens"))), F.lit(1.0)).alias("least")).first()
    passes = F.when(F.col("tokens") > 0, F.round(F.col("raised") / F.col("tokens") / F.lit(sums["least"]), 9)).otherwise(1.0)
    return figures.select(source, "tokens", "documents", (F.col("raised") / F.lit(sums["z"] or 1.0)).alias("weight"), passes.alias("passes")), power


def schedule(docs: DataFrame, goal: Goal, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """(doc, doc_id, source, tokens, weight, passes, exponent, block, place, copies) per distinct document.

    ``doc`` is ``identity(id, text, source)``; repeated rows are one document
    with their tokens added up, and each of them is taken ``copies`` times.
    ``place`` is the rank of a document in its block. A null source is a source
    of its own; a null text has no tokens and rides along in every full pass. An
    empty table gives no rows.
    """
    per_row = docs.select(
        identity(F.col(id_col), F.col(text_col), F.col(source_col)).alias("doc"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        marked(F.col(source_col)).alias("_key"),
        (word_tokens(F.col(text_col)) if tokens is None else tokens).alias("tokens"),
    )
    units = settled(per_row.groupBy("doc", "doc_id", "source", "_key").agg(F.sum("tokens").alias("tokens")), "mixing-units")
    table, power = weights(units, goal, "_key", "tokens")
    table = settled(
        table.select(
            "_key",
            "weight",
            "passes",
            F.floor("passes").cast("int").alias("_full"),
            ((F.col("passes") - F.floor("passes")) * F.col("tokens")).alias("_rest"),
            F.greatest(F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / BLOCK_TOKENS), F.ceil(F.col("documents") / BLOCK_ROWS)).cast("int").alias("_blocks"),
        ),
        "source-weights",
    )
    dealt = units.join(table, "_key").withColumn("block", part_by_digest(F.col("doc"), F.col("_blocks")))
    order = F.md5(F.col("block").cast("string"))
    before = Window.partitionBy("_key").orderBy("_order", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        dealt.groupBy("_key", "block")
        .agg(F.sum("tokens").alias("_sum"))
        .withColumn("_order", order)
        .select("_key", "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_key", "block").orderBy("doc")
    ranked = dealt.withColumns(
        {"place": F.row_number().over(inside) - 1, "_within": F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    ).join(blocks, ["_key", "block"])
    extra = ((F.col("_before") + F.col("_within")) < F.col("_rest")).cast("int")
    return ranked.select(
        "doc", "doc_id", "source", "tokens", "weight", "passes", F.lit(power).alias("exponent"), "block", "place", (F.col("_full") + extra).alias("copies")
    )


def mixed(docs: DataFrame, goal: Goal = Goal(), source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, each row as often as the mixture takes it, at least once."""
    doc, copies = free_names(docs, "_doc", "_copies")
    plan = schedule(docs, goal, source_col, id_col, text_col).select(F.col("doc").alias(doc), F.col("copies").alias(copies))
    named = docs.withColumn(doc, identity(F.col(id_col), F.col(text_col), F.col(source_col)))
    return named.join(plan, doc).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
