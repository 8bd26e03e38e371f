"""Quality rules: base rules, and a hashed n-gram likelihood ratio.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted: one of the whole raw corpus, one of
trusted documents. A document's score is the mean log ratio of its n-grams, so
long and short texts compare. Every document is held against one threshold.
Half of the labelled documents fill the trusted counts, the other half places
the threshold, as a document scores higher on counts that hold its own words.
Log ratios are whole millionths, so sums do not depend on an order and a verdict
never flips between runs.

All of it is DataFrame work. The ratios are one array of a fixed length that
each row folds its buckets over, so scoring moves no rows; that array and the ids
of the labelled documents are all that is sent to the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.shared import free_names, identity, words
from strata.session import settled

BUCKETS = 1 << 16
#: Labelled documents of each kind: half of them fit the target, the others the threshold.
LABELLED = 20_000
#: Of the good documents that place the threshold, the share that must pass.
GOOD_KEPT = 0.99
#: Log ratios are kept in units of one by this.
UNIT = 1_000_000
SMOOTHING = 0.5
REPEAT_WORDS = 5


def word_hashes(found: Column) -> Column:
    return F.transform(found, lambda word: F.xxhash64(word))


def gram_buckets(hashes: Column) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    pairs = F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    real = F.slice(pairs, 1, F.greatest(F.size(hashes) - 1, F.lit(0)))
    return F.concat(
        F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")),
        F.transform(real, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")),
    )


def window_hashes(hashes: Column, size: int = REPEAT_WORDS) -> Column:
    """Hash of each window of ``size`` words, none for shorter texts."""
    return F.when(
        F.size(hashes) >= size,
        F.transform(F.sequence(F.lit(1), F.size(hashes) - (size - 1)), lambda i: F.xxhash64(F.slice(hashes, i, size))),
    ).otherwise(F.array().cast("array<bigint>"))


def base_columns(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and buckets.

    The steps are separate selects so that no array is computed inside the
    lambda of another one. Only texts that repeat a window at all sort theirs.
    """
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda line: F.trim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    raw = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(
        *keep,
        words(F.col(text)).alias("_words"),
        lines.alias("_lines"),
        (F.size(F.split(raw, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
    )
    step = step.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        word_hashes(F.col("_words")).alias("_hashes"),
    )
    before = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    step = step.select(*before, gram_buckets(F.col("_hashes")).alias("_buckets"), window_hashes(F.col("_hashes")).alias("_windows"))
    step = step.select(
        *before,
        "_buckets",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_sorted"),
    )
    same = lambda i, j: F.get(F.col("_sorted"), i)["h"] == F.get(F.col("_sorted"), j)["h"]
    repeated = F.filter(
        "_sorted", lambda x, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
    )
    step = step.select(*before, "_buckets", F.array_sort(F.transform(repeated, lambda x: x["i"])).alias("_starts"))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(
            (i + REPEAT_WORDS).alias("end"), (acc["n"] + i + REPEAT_WORDS - F.greatest(i, acc["end"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return step.select(*before, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "_buckets")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


def labelled_sample(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(doc_id, good, fits) of at most ``limit`` documents of each quality.

    The documents with the smallest hashes are taken, by turns to fit the target
    and to place the threshold. Labels that contradict one another, or lack an id
    or a quality, are left out.
    """
    clear = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high")
        .select("doc_id", (F.col("low") == 1).alias("good"))
    )
    pick = lambda good: clear.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    turn = F.row_number().over(Window.partitionBy("good").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return pick(True).union(pick(False)).select("doc_id", "good", (turn % 2 == 1).alias("fits"))


def ratios(grams: DataFrame) -> DataFrame:
    """(bucket, ratio) in units from rows (bucket, trusted), one for each n-gram of the corpus."""
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("trusted")).alias("target"))
    counts = settled(counts, "gram-counts")
    sums = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    share = lambda n, total: F.log((F.col(n) + SMOOTHING) / F.lit(total + SMOOTHING * BUCKETS))
    return counts.select("bucket", F.round((share("target", sums["target"]) - share("raw", sums["raw"])) * UNIT).cast("long").alias("ratio"))


def as_array(table: DataFrame) -> Column:
    """The ratios of all ``BUCKETS`` buckets in order as one constant; buckets that no n-gram fell into have 0."""
    found = dict(table.collect())  # at most BUCKETS rows
    return F.split(F.lit(",".join(str(found.get(bucket, 0)) for bucket in range(BUCKETS))), ",").cast("array<bigint>")


def threshold(scored: DataFrame) -> int:
    """The score, in units, below which a document goes.

    Only labelled documents that the target was not counted from are asked, and
    of those the ones that pass the base rules. Of the cuts that keep the share
    ``GOOD_KEPT`` of the good ones, the cut with the best mean of both recalls is
    taken, the lowest of the best; the threshold lies halfway to the next score
    below. Without such documents of both kinds nothing goes. At most
    ``LABELLED`` rows are ordered here.
    """
    lowest = -(1 << 62)
    up = Window.orderBy("score")
    cuts = (
        scored.filter(F.col("good").isNotNull() & ~F.col("fits") & ~F.col("base_failed"))
        .groupBy("score")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
        .select(
            "score",
            F.sum("good").over(Window.partitionBy()).alias("all_good"),
            F.sum("bad").over(Window.partitionBy()).alias("all_bad"),
            F.coalesce(F.sum("good").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("good_below"),
            F.coalesce(F.sum("bad").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bad_below"),
            F.lag("score").over(up).alias("below"),
        )
        .filter((F.col("all_good") > 0) & (F.col("all_bad") > 0) & (F.col("good_below") <= F.floor(F.col("all_good") * (1 - GOOD_KEPT))))
        .select("score", "below", ((F.col("all_good") - F.col("good_below")) * F.col("all_bad") + F.col("bad_below") * F.col("all_good")).alias("gain"))
        .orderBy(F.desc("gain"), "score")
        .first()
    )
    if cuts is None or cuts["below"] is None:
        return lowest
    return (cuts["score"] + cuts["below"]) // 2


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, doc, the base figures, score, base_failed, kept.

    ``doc`` is ``identity(id, text)``. Each row of the input has a row here,
    repeated rows and those without an id too. A null text has no words and
    fails. A text that passes the base rules is kept if its score reaches the
    threshold. With no labels, or no good ones, the base rules alone decide.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), identity(F.col(id_col), F.col(text_col)).alias("doc"))
    sample = settled(labelled_sample(labels), "labelled")
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    known = named.join(F.broadcast(sample), "doc_id", "left")
    grams = known.select((F.col("good") & F.col("fits")).alias("trusted"), word_hashes(words(F.col("_text"))).alias("_hashes")).select(
        "trusted", F.explode(gram_buckets(F.col("_hashes"))).alias("bucket")
    )
    table = as_array(ratios(grams))
    total = F.aggregate("_buckets", F.lit(0).cast("long"), lambda acc, bucket: acc + F.get(table, bucket))
    keep = ["doc_id", "doc", "good", "fits"]
    scored = base_columns(known, "_text", keep).select(
        *keep,
        *figures,
        F.coalesce(F.floor(F.try_divide(total, F.size("_buckets"))), F.lit(0)).cast("long").alias("score"),
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
    )
    scored = settled(scored, "quality-scores")
    return scored.select("doc_id", "doc", *figures, "score", "base_failed", (~F.col("base_failed") & (F.col("score") >= threshold(scored))).alias("kept"))


def quality_kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns; repeated rows stay repeated."""
    (doc,) = free_names(docs, "doc")
    kept = verdicts(docs, labels, id_col, text_col).filter("kept").select(F.col("doc").alias(doc)).distinct()
    return docs.withColumn(doc, identity(F.col(id_col), F.col(text_col))).join(kept, doc, "left_semi").select(*docs.columns)
