"""Benchmark decontamination with suffix arrays over the training texts.

Every shard of documents (an Arrow batch of a map task) gets a suffix array of
its words, sorted by the next thirteen. Each suffix of a benchmark item is
looked up in it by binary search; the suffixes of the shard that share its
window are adjacent, and their positions are verbatim matches, which are then
followed to their last common word. A match of two words or more begins with a
word pair of the benchmark, so suffixes that don't are left out of the array: it
holds all that a search can meet.

The benchmark goes to the tasks in blocks of a fixed size, one pass for each;
a pass is written before the next one starts, so neither the driver nor a task
holds more than one block. Documents never move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import free_names
from strata.session import settled

#: Words of a window.
WINDOW = 13
#: Bytes of benchmark text that one pass broadcasts.
BLOCK_BYTES = 8_000_000
#: Bytes of text whose suffixes are sorted together.
SHARD_BYTES = 8_000_000

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

HITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_HITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
MATCHES = T.ArrayType(
    T.StructType(
        [T.StructField("item", T.StringType()), T.StructField("words", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("item_start", T.IntegerType())]
    )
)
_ARROW_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("words", pa.int32()), ("start", pa.int32()), ("item_start", pa.int32())]))

#: A match: words, place in the document, place in the item.
Match = tuple[int, int, int]


def word_list(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of letters, digits and characters beyond ASCII."""
    return text.translate(_WORD_BYTES).split() if text else []


class TestSuffixes:
    """The suffixes of some benchmark items, sorted by their windows, ready for binary search.

    An item of at least a window's words has a suffix for each window, a shorter
    one a single suffix, which is its window. All is kept in flat arrays.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        self.names = [item for item, _ in items]
        split = [word_list(text) for _, text in items]
        self.ids = {word: i for i, word in enumerate(sorted({w for found in split for w in found}), 1)}
        self.foreign = len(self.ids) + 1
        end = self.foreign + 1  # around each item; no document has it
        self.codes = np.array([end, *(code for found in split for code in (*map(self.ids.__getitem__, found), end))], np.int64)
        sizes = np.array([len(found) for found in split], np.int64)
        begin = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(split) else np.empty(0, np.int64)
        counts = np.where(sizes >= window, sizes - window + 1, np.minimum(sizes, 1))
        item = np.repeat(np.arange(len(split)), counts)
        place = np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
        at, length = begin[item] + place, np.minimum(sizes[item], window)
        inside = np.arange(window) < length[:, None]
        rows = np.where(inside, self.codes[np.minimum(at[:, None] + np.arange(window), len(self.codes) - 1)], 0)
        keys = as_keys(rows)
        order = np.argsort(keys, kind="stable")
        #: Suffixes in the order of their windows: position, item, place in it.
        self.at, self.item, self.place = at[order], item[order], place[order]
        ordered = keys[order]
        fresh = np.flatnonzero(np.append([True], ordered[1:] != ordered[:-1])) if len(order) else np.empty(0, np.int64)
        #: Per distinct window: its first suffix (and the end), words, least and largest key that begins with it.
        self.bounds = np.append(fresh, len(order))
        self.lengths = length[order][fresh]
        self.low = ordered[fresh]
        self.high = as_keys(np.where(inside, rows, 0xFFFFFFFF)[order][fresh])
        first, second = rows[order][fresh][:, 0], rows[order][fresh][:, min(1, window - 1)]
        self.pairs = np.unique((first * (self.foreign + 1) + second)[self.lengths > 1])
        self.single = np.unique(first[self.lengths == 1])


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of codes as byte strings in the same order."""
    big = np.ascontiguousarray(rows.astype(">u4"))
    return big.view(f"S{4 * rows.shape[1]}").ravel() if len(rows) else np.empty(0, f"S{4 * rows.shape[1]}")


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of the ``depth`` codes that follow, and these as keys."""
    padded = np.concatenate([codes, np.zeros(depth, codes.dtype)]).astype(np.uint32)
    keys = as_keys(np.lib.stride_tricks.sliding_window_view(padded, depth)[starts])
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


def followed(flat: np.ndarray, positions: np.ndarray, tests: TestSuffixes, at: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the positions that share a window with the suffix those where a match begins, and its words.

    A match begins where the words before differ; it is followed to its end.
    """
    starts = positions[flat[positions - 1] != tests.codes[at - 1]]
    words, alive, k = np.full(len(starts), length, np.int64), np.arange(len(starts)), length
    while len(alive := alive[flat[starts[alive] + k] == tests.codes[at + k]]):
        k += 1
        words[alive] = k
    return starts, words


def better(a: Match, b: Match | None) -> bool:
    """Longer, or as long and earlier in the document, then in the item."""
    return b is None or (-a[0], a[1], a[2]) < (-b[0], b[1], b[2])


def search_shard(texts: list[bytes | None], tests: TestSuffixes) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[dict[str, Match]]]:
    """Words, merged matches (start, end in words) and the longest match with each item, for each text."""
    lookup, foreign, sizes, codes = tests.ids.get, tests.foreign, [], [np.zeros(1, np.int64)]
    for text in texts:
        found = word_list(text)
        sizes.append(len(found))
        codes.append(np.fromiter((lookup(word, foreign) for word in found), np.int64, len(found)))
        codes.append(np.zeros(1, np.int64))  # no match goes over the end of a text
    sizes = np.array(sizes, np.int64)
    hits: list[list[tuple[int, int]]] = [[] for _ in texts]
    longest: list[dict[str, Match]] = [{} for _ in texts]
    if not len(texts) or not len(tests.low):
        return sizes, hits, longest
    flat = np.concatenate(codes)
    first = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    pairs = flat[:-1] * (foreign + 1) + flat[1:]
    useful = np.append(np.isin(pairs, tests.pairs), False) | np.isin(flat, tests.single)
    starts, keys = suffix_array(flat, np.flatnonzero(useful), tests.window)
    low, high = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    spans = []
    for w in np.flatnonzero(high > low):
        positions, length = starts[low[w] : high[w]], tests.lengths[w]
        owners = np.searchsorted(first, positions, "right") - 1
        spans.append((owners, positions - first[owners], np.full(len(positions), length)))
        for suffix in range(tests.bounds[w], tests.bounds[w + 1]):
            begins, words = followed(flat, positions, tests, tests.at[suffix], length)
            name, place = tests.names[tests.item[suffix]], int(tests.place[suffix])
            of = np.searchsorted(first, begins, "right") - 1
            for owner, begin, n in zip(of.tolist(), (begins - first[of]).tolist(), words.tolist(), strict=True):
                if better(match := (n, begin, place), longest[owner].get(name)):
                    longest[owner][name] = match
    if spans:
        owners, begins, lengths = (np.concatenate(part) for part in zip(*spans, strict=True))
        for i in np.lexsort((begins, owners)):
            own, begin, end = hits[owners[i]], int(begins[i]), int(begins[i] + lengths[i])
            if own and begin <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], end))
            else:
                own.append((begin, end))
    return sizes, hits, longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _pass(tests, text: int, words: int, hits: int, longest: int):
    """Adds the matches of one block of items to the columns at these places."""

    def shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        begin, held = 0, 0
        for row, size in enumerate(pa.compute.binary_length(batch.column(text)).to_pylist()):
            held += size or 0
            if held >= SHARD_BYTES:
                yield batch.slice(begin, row + 1 - begin)
                begin, held = row + 1, 0
        if begin < len(batch):
            yield batch.slice(begin)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in shards(batch):
                sizes, found, matched = search_shard(shard.column(text).cast(pa.binary()).to_pylist(), tests.value)
                spans, best = [], []
                for old, new, before, now in zip(shard.column(hits).to_pylist(), found, shard.column(longest).to_pylist(), matched, strict=True):
                    spans.append([{"start": a, "end": b} for a, b in _merged([(x["start"], x["end"]) for x in old] + new)])
                    for x in before:
                        if better(match := (x["words"], x["start"], x["item_start"]), now.get(x["item"])):
                            now[x["item"]] = match
                    best.append([{"item": name, "words": n, "start": at, "item_start": place} for name, (n, at, place) in sorted(now.items())])
                for place, values in ((words, pa.array(sizes, pa.int64())), (hits, pa.array(spans, _ARROW_HITS)), (longest, pa.array(best, _ARROW_MATCHES))):
                    shard = shard.set_column(place, shard.schema.field(place).name, values)
                yield shard

    return apply


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items, some millions of bytes at a time; one empty block where there are none."""
    block, size, any_block = [], 0, False
    for row in benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(text_col).cast("binary")).toLocalIterator():
        block.append((row[0], bytes(row[1]) if row[1] is not None else None))
        size += len(row[1] or b"")
        if size >= BLOCK_BYTES:
            yield block
            block, size, any_block = [], 0, True
    if block or not any_block:
        yield block


def matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> tuple[DataFrame, str, str, str]:
    """The documents with three more columns, and their names: words, hits, longest.

    ``hits`` are the disjoint spans of words, ends exclusive, that lie inside a
    verbatim occurrence of ``window`` consecutive words of an item, or of a
    whole item with fewer words; spans that touch are one. ``longest`` has the
    longest verbatim match with each item that occurs, by item id as a string (a
    null id is ``null``): its words, and where it starts in the document and in
    the item, the first such place of ties. A null or empty text has no words; an
    item without words occurs nowhere. The new columns take names that the
    documents don't have.
    """
    spark = docs.sparkSession
    n_words, hits, longest = free_names(docs, "n_words", "hits", "longest")
    out = docs.withColumns({n_words: F.lit(0).cast("long"), hits: F.array().cast(HITS), longest: F.array().cast(MATCHES)})
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    places = [out.columns.index(name) for name in (text_col, n_words, hits, longest)]
    held = None
    for block in _blocks(benchmark, item_col, item_text):
        if held is not None:
            out = settled(out, "matches")
            held.destroy()
        held = spark.sparkContext.broadcast(TestSuffixes(block, window))
        out = out.mapInArrow(_pass(held, *places), schema)
    return out, n_words, hits, longest


def matched_items(longest: str) -> Column:
    return F.transform(F.col(longest), lambda match: match["item"])


def hit_words(hits: str) -> Column:
    return F.aggregate(F.col(hits), F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])


def is_contaminated(n_words: Column, n_hit: Column, share: int = 20) -> Column:
    """Some word is hit, and one in ``share`` at least."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: int = 20) -> DataFrame:
    """The documents, without those that are contaminated."""
    found, n_words, hits, _ = matches(docs, benchmark, text_col)
    return found.filter(~is_contaminated(F.col(n_words), hit_words(hits), share)).select(*docs.columns)
