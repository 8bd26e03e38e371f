"""Token counts through a table of known digests.

The cache holds (digest of the content, tokens) per tokenizer version. A run
joins the digests of its documents to it, encodes each missing content once,
appends the new counts and reads all counts from the cache. The folder is the
caller's and lasts: later runs find what earlier ones encoded, and each result
tells which counts were known before.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import settled

#: Segments whose counts a worker remembers, the first that it meets.
REMEMBERED = 1_000_000
#: Texts encoded together.
SLICE = 500
#: Fixed value: how the library writes a space.
SPACE_MARK = "▁"


def tokenizer_version(model: bytes) -> str:
    return sha256(model + sentencepiece.__version__.encode()).hexdigest()


def separable(processor: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether no piece goes on over the end of a word.

    Then merges never cross the border between a character and a following
    space, and a text has as many tokens as its space-led segments together.
    """
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece) for piece in pieces):
        return False
    # The library must put a mark before a text, and keep runs of spaces.
    parts = [piece for segment in ("a", " b", "\n", "c") for piece in processor.encode(segment, out_type=str)]
    return processor.encode("a  b \n c ", out_type=str) == [*parts, SPACE_MARK]


class Counter:
    """Counts tokens as the library does; the counts of short segments are remembered."""

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_segment = separable(self.processor)
        self.known: dict[str, int] = {"": 1}

    def segments(self, text: str) -> list[str]:
        """Parts whose tokens add up to those of the text.

        The one space at each border stands for the mark that the library puts
        before a segment. An empty last segment is a final space, one token.
        """
        if not self.by_segment or SPACE_MARK in text:
            return [text]
        return re.split(r"(?<=[^ ]) ", text) if "  " in text or text[0] == " " else text.split(" ")

    def count(self, texts: list[str | None]) -> list[int]:
        parts = [self.segments(text) if text else [] for text in texts]
        new = list({segment for segments in parts for segment in segments}.difference(self.known))
        found = dict(zip(new, map(len, self.processor.encode(new, num_threads=1)), strict=True))
        totals = [sum(self.known[s] if s in self.known else found[s] for s in segments) for segments in parts]
        for segment, n in found.items():
            if len(self.known) >= REMEMBERED:
                break
            if len(segment) <= 64:
                self.known[segment] = n
        return totals


def _encoded(model: bytes):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(model)
            for start in range(0, len(batch), SLICE):
                part = batch.slice(start, SLICE)
                counts = counter.count(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0).cast(pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return apply


def content_digest(text):
    """Digest of the normalised content: a null text is empty, nothing else changes a count."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_cache(spark: SparkSession, folder: str, run: str = "") -> DataFrame:
    """Known counts, one row per digest, ``cached`` where another run than ``run`` stored it; none where nothing was stored yet."""
    stored = "digest binary, n_tokens long, batch string"
    try:
        rows = spark.read.schema(stored).option("basePath", folder).parquet(f"{folder}/batch=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], stored)
    # Runs that overlap in time may store a digest twice.
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"), F.bool_or(F.col("batch") != run).alias("cached"))


def extend_cache(docs: DataFrame, folder: str, model: bytes, text_col: str = "text") -> DataFrame:
    """Encode the contents that the cache lacks, append them, return the cache.

    ``cached`` tells the contents that were there before. A third of all rows may
    share one content: each map task gives on one row per digest only, so that
    neither the shuffle nor a task grows with it.
    """
    spark, run = docs.sparkSession, f"run-{uuid.uuid4().hex}"
    versioned = f"{folder}/tokenizer={tokenizer_version(model)}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    distinct = docs.select(content_digest(F.col(text_col)).alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    misses = distinct.join(read_cache(spark, versioned), "digest", "left_anti").select("digest", "text")
    misses.mapInArrow(_encoded(model), "digest binary, n_tokens long").write.parquet(f"{versioned}/batch={run}")
    return read_cache(spark, versioned, run)


def share_of_contents(docs: DataFrame, part: int = 16, text_col: str = "text") -> DataFrame:
    """The documents whose content falls into one of ``part`` equal ranges of digests, the first."""
    first = F.conv(F.substring(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), 1, 8), 16, 10).cast("long")
    return docs.filter(first * part < F.lit(1 << 32))


def token_counts(docs: DataFrame, folder: str, model: bytes, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """The documents' columns other than the text, with n_bytes, n_tokens, over_limit and cached.

    Each row keeps its place in the result, repeated ones and those without an
    id too; a null or empty text has 0 bytes and 0 tokens. ``cached`` rows were
    counted by an earlier run over the same folder with the same tokenizer. Columns of the input
    that are named like a result are left out.
    """
    made = {"digest", "n_bytes", "n_tokens", "over_limit", "cached"}
    kept = [name for name in docs.columns if name != text_col and name.lower() not in made]
    # Written as a plain table, so that Spark can cut the join where many rows share a content.
    cache = settled(extend_cache(docs, folder, model, text_col), "token-counts")
    keyed = docs.select(*kept, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), content_digest(F.col(text_col)).alias("digest"))
    return keyed.join(cache, "digest", "left").select(*kept, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cached")
