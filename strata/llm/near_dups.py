"""Near-duplicate groups by MinHash.

Documents with the same shingle set are one class. Each class has the minima of
160 universal hash functions; 40 bands of four minima put similar classes into
common buckets (a pair at 0.85 is in none with a chance of 1e-13, at 0.8 of
7e-10). Within a bucket each class is held against two leaders; links are
filtered by signature and confirmed on full sets, and components formed by
alternating large-star and small-star. Buckets that then still hold several
components are finished: every class outside the bucket's largest component is
held against all others, in blocks, pairs that share a component excepted, until
it has one link to each component that it has any to. So no link between two
components is lost, and none within one is needed. A bucket with a third of all
rows is cut into blocks of classes, and a leader's rows into blocks of partners.

Classes that meet many others in buckets that stay split are a family whose
members are alike, but mostly not enough, such as the pages of one template; to
hold all of them against each other would be quadratic. The classes of such
buckets are dealt anew by their rarest shingles:
two sets of sizes a and b that share the wanted part share one of their first
a - o + 1 and b - o + 1 shingles in any common order, o being the overlap that a
and b ask for. In the order of rarity these are the shingles a class has for its
own, so classes that share a template only never meet, and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.shared import free_names, identity
from strata.session import settled

BANDS, ROWS = 40, 4
MINIMA = BANDS * ROWS
#: Shingles hashed together, so that they stay in the cache.
SLICE = 1 << 15
#: Classes of a block of a bucket; partners of a leader that one task confirms.
BLOCK = 512
#: Classes that one class may meet in buckets that stay split; where it would meet more, its buckets are dealt anew by rare shingles.
FAMILY = 64
#: Counters of shingles, by which they are ordered from rare to frequent.
COUNTERS = 1 << 20
#: Standard deviations that a signature may fall short of the similarity.
MARGIN = 6.0

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_draw = np.random.default_rng(20240229)
_FACTORS = _draw.integers(1, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _draw.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; one for a shorter text, none without words."""
    found = text.translate(_LOWER).split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(size, len(found))
    count = len(found) - size + 1
    rolled = np.zeros(count, np.uint64)
    for k in range(size):
        rolled = _mixed(rolled * _MIX + hashes[k : k + count])
    return np.unique(rolled)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of all hash functions, one row for each set, none of them empty."""
    out = np.empty((len(sets), MINIMA), np.uint32)
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (held == 0 or held + len(sets[end]) <= SLICE):
            held += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets[start:end]])[:-1]])
        for i in range(MINIMA):
            out[start:end, i] = np.minimum.reduceat(flat * _FACTORS[i] + _TERMS[i], cuts) >> np.uint64(32)
        start = end
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band; the band is part of it."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(minima), BANDS)).copy()
    for k in range(ROWS):
        keys = _mixed(keys * _MIX + minima[:, k::ROWS].astype(np.uint64))
    return keys.view(np.int64)


def sketches(minima: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (_mixed(minima.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)


def enough(percent: int) -> int:
    """Bytes of two sketches that must agree for a pair to be confirmed."""
    p = percent / 100 + (1 - percent / 100) / 256
    return math.floor(MINIMA * p - MARGIN * math.sqrt(MINIMA * p * (1 - p)))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def size_class(size: int) -> int:
    """Sizes in steps of a fiftieth, each size by itself below 50."""
    return size if size < 50 else 50 + int(math.log(size / 50) / math.log(1.02))


def least_of_class(number: int) -> int:
    """The smallest size of a class."""
    if number < 50:
        return number
    size = math.floor(50 * 1.02 ** (number - 50))
    while size_class(size) < number:
        size += 1
    while size_class(size - 1) >= number:
        size -= 1
    return size


#: Sides of a key: of the smaller and of the larger size class, and of one class for both or of a bucket.
SMALLER, LARGER, EITHER = 0, 1, 2


def rare_keys(shingles: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, with their sides, of which two sets share one if they share the wanted part of their shingles.

    A key is a shingle with the size classes of both sets; for every class of
    partners a set has the rarest shingles that partners of the class's least
    size call for. Sets of one class meet by keys of that class only, so a key of
    two classes joins sets of different sides.
    """
    n = len(shingles)
    slots = (shingles >> np.uint64(20)).astype(np.int64) % COUNTERS
    ordered = shingles[np.lexsort((shingles, counts[slots]))]
    own, out, sides = size_class(n), [], []
    least, most = -(-percent * n // 100), 100 * n // percent
    for other in range(size_class(least), size_class(most) + 1):
        partner = max(least_of_class(other), least)
        overlap = -(-percent * (n + partner) // (100 + percent))
        if 0 < overlap <= n:
            classes = np.uint64((min(own, other) << 32) | max(own, other))
            out.append(_mixed(ordered[: n - overlap + 1] * _MIX + _mixed(np.array([classes]))[0]))
            sides.append(np.full(len(out[-1]), EITHER if own == other else SMALLER if own < other else LARGER, np.int32))
    return np.concatenate(out).view(np.int64), np.concatenate(sides)


def _counted(size: int):
    """How often each counter is met by the shingles of (id, text)."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                slots = (shingle_set(text.as_py(), size) >> np.uint64(20)).astype(np.int64) % COUNTERS
                counts += np.bincount(slots, minlength=COUNTERS)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["slot", "n"])

    return apply


def _dealt_by_rarity(counts: np.ndarray, size: int, percent: int):
    """(key, side, id) for each rare key of (id, text)."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                keys, sides = rare_keys(shingle_set(text.as_py(), size), counts, percent)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sides), pa.array(np.full(len(keys), own, np.int64))], names=["bucket", "side", "id"])

    return apply


_SKETCHED = T.StructType(
    [
        T.StructField("doc", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _sketched(size: int):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 200):
                batch = whole.slice(start, 200)
                sets = [shingle_set(text.as_py(), size) for text in batch.column("text")]
                full = [i for i, s in enumerate(sets) if len(s)]
                minima = signatures([sets[i] for i in full])
                keys, marks = band_keys(minima), sketches(minima)
                digest, sketch, bands = ([None] * len(sets) for _ in range(3))
                for place, i in enumerate(full):
                    digest[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    sketch[i], bands[i] = marks[place].tobytes(), keys[place]
                made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, "n_shingles", "digest", "sketch", "bands"])

    return apply


def _agreeing(needed: int):
    """Of rows (a, b, sketch_a, sketch_b) the pairs whose sketches agree enough."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, MINIMA) for k in (2, 3))
                keep = (a == b).sum(1) >= needed
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return apply


def _candidates(needed: int):
    """Per probe and block of a component the members to confirm, from rows sorted by (bucket, block, role).

    The probes of a block come first (role 0) and are held; members are compared
    as they come. A pair of one component is left out, as is one that an earlier
    bucket of both has: its band is the first in which the bands agree. Pairs met
    by a rare shingle are not told apart in this way. Of two probes the one with
    the smaller id is held against the other.
    """

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, probes = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in ("bucket", "block", "role")), strict=True))
            ids, comps, parts, probing, side, banded = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("id", "comp", "part", "probing", "side", "banded"))
            marks = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, MINIMA)
            bands = batch.column("bands").flatten().to_numpy().reshape(-1, BANDS)
            found: dict[tuple[int, int, int], list[int]] = {}
            start = 0
            while start < len(keys):
                end = start + 1
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                if keys[start][:2] != at:
                    at, probes = keys[start][:2], []
                if keys[start][2] == 0:
                    probes.append((ids[start:end], comps[start:end], side[start:end], marks[start:end], bands[start:end]))
                else:
                    for p_ids, p_comps, p_side, p_marks, p_bands in probes:
                        for m in range(start, end):
                            rows = np.flatnonzero((p_comps != comps[m]) & ((p_ids < ids[m]) | ~probing[m]) & ((p_side == EITHER) | (p_side != side[m])))
                            rows = rows[(p_marks[rows] == marks[m]).sum(1) >= needed]
                            if len(rows) and banded[m]:
                                rows = rows[p_bands[rows, (p_bands[rows] == bands[m]).argmax(1)] == at[0]]
                            for probe in p_ids[rows]:
                                found.setdefault((int(probe), int(comps[m]), int(parts[m])), []).append(int(ids[m]))
                start = end
            if found:
                probe, comp, part = (pa.array(c, pa.int64()) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([probe, comp, part, pa.array(found.values(), pa.list_(pa.int64()))], names=["probe", "comp", "part", "members"])

    return apply


def _connected(size: int, percent: int):
    """A link of each probe to a component that it has one to.

    Rows are sorted by (comp, part, role): some members of a component first
    (role 0), which are held, then the probes with the members to look at.
    """

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        for batch in batches:
            a, b = [], []
            names = ("comp", "part", "role", "id", "members", "text")
            for comp, part, role, own, members, text in zip(*(batch.column(n) for n in names), strict=True):
                if (comp.as_py(), part.as_py()) != at:
                    at, held = (comp.as_py(), part.as_py()), {}
                found = shingle_set(text.as_py(), size)
                if role.as_py() == 0:
                    held[own.as_py()] = found
                elif (link := next((m for m in members.as_py() if similar(held[m], found, percent)), None)) is not None:
                    a.append(own.as_py())
                    b.append(link)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return apply


def _confirmed(size: int, percent: int):
    """Links from rows sorted by (lead, part, role): a leader's text, then those of its partners."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, own = None, None
        for batch in batches:
            a, b = [], []
            for leader, role, other, text in zip(*(batch.column(n) for n in ("lead", "role", "id", "text")), strict=True):
                found = shingle_set(text.as_py(), size)
                if role.as_py() == 0:
                    lead, own = leader.as_py(), found
                elif lead == leader.as_py() and similar(own, found, percent):
                    a.append(lead)
                    b.append(other.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return apply


class NearDuplicates:
    """Near-duplicate groups of documents.

    ``percent`` is the least similarity of a link: 100 times the common shingles
    by all shingles of both. Texts are lower-cased in A-Z and split at white
    space; a text with fewer words than a shingle is one shingle; null and empty
    texts have none and are linked with nothing. Repeated rows are copies. Null
    ids are allowed; a group of nothing else has a null id.
    """

    def __init__(self, docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"):
        self.size, self.percent = size, percent
        named = docs.select(F.col(id_col).alias("doc_id"), identity(F.col(id_col), F.col(text_col)).alias("doc"), F.col(text_col).cast("binary").alias("text"))
        self.texts = named
        schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *_SKETCHED.fields])
        self.rows = settled(named.mapInArrow(_sketched(size), schema), "sketches")
        # Ids of classes are given once and then read.
        classes = self.rows.filter("n_shingles > 0").dropDuplicates(["digest"]).withColumn("id", F.monotonically_increasing_id())
        self.classes = settled(classes.select("id", "digest", "doc", "sketch", "bands"), "classes")

    def _texts_of(self, wanted: DataFrame) -> DataFrame:
        """The wanted rows (with ``id``) and the texts of their classes, one for each however often its row is repeated."""
        wanted = wanted.join(self.classes.select("id", "doc"), "id")
        texts = self.texts.select("doc", "text").join(wanted.select("doc").distinct(), "doc", "left_semi")
        first = Window.partitionBy("doc").orderBy(F.lit(0))
        once = texts.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")
        return wanted.join(once, "doc").drop("doc")

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that hold on full sets."""
        pairs = settled(pairs.distinct(), "candidates")
        parts = settled(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "leaders")
        placed = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
        wanted = placed.select(F.col("a").alias("id"), F.col("a").alias("lead"), "part", F.lit(0).alias("role")).distinct()
        wanted = wanted.union(placed.select(F.col("b").alias("id"), F.col("a").alias("lead"), "part", F.lit(1).alias("role")))
        ordered = self._texts_of(wanted).repartition("lead", "part").sortWithinPartitions("lead", "part", "role")
        return settled(ordered.select("lead", "role", "id", "text").mapInArrow(_confirmed(self.size, self.percent), "a long, b long"), "links")

    def _members(self) -> DataFrame:
        """(bucket, n, l1, l2, id) for buckets of two classes or more; l1 and l2 lead them."""
        banded = self.classes.select("id", F.explode("bands").alias("bucket"))
        buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("l1"), F.min(F.struct(F.xxhash64("id"), "id")).alias("l2"))
        # Written first, so that the join below has a plain side and Spark can cut a hot bucket.
        buckets = settled(buckets.filter("n > 1").select("bucket", "n", "l1", F.col("l2.id").alias("l2")), "bucket-leaders")
        return settled(banded.join(buckets, "bucket"), "buckets")

    def links(self) -> DataFrame:
        """Links (a, b) between classes that connect all that are connected."""
        members, needed = self._members(), enough(self.percent)
        led = members.select("id", F.explode(F.array_distinct(F.array("l1", "l2"))).alias("l")).filter("id != l")
        led = led.select(F.least("id", "l").alias("a"), F.greatest("id", "l").alias("b")).distinct()
        sketch = self.classes.select("id", "sketch")
        led = led.join(sketch.toDF("a", "sketch_a"), "a").join(sketch.toDF("b", "sketch_b"), "b")
        links = self._links(led.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_agreeing(needed), "a long, b long"))
        return links.union(self._missing_links(members, components(links), needed))

    def _missing_links(self, members: DataFrame, comps: DataFrame, needed: int) -> DataFrame:
        """Links between components that share a bucket, from each probe to each such component."""
        nodes = self.classes.select("id").join(comps, F.col("id") == F.col("node"), "left").select("id", F.coalesce("comp", "id").alias("comp"))
        sizes = settled(nodes.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("parts")), "component-sizes")
        nodes = settled(nodes.join(sizes, "comp").select("id", "comp", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")), "nodes")
        held = settled(members.select("bucket", "n", "id").join(nodes, "id"), "bucket-components")
        split = held.groupBy("bucket").agg(F.count_distinct("comp").alias("comps")).filter("comps > 1").select("bucket")
        in_split = settled(held.join(settled(split, "split-buckets"), "bucket"), "split-classes")
        busy = in_split.groupBy("id").agg(F.sum(F.col("n") - 1).alias("meets")).filter(F.col("meets") > FAMILY).select("id")
        families = settled(in_split.join(busy, "id", "left_semi").select("bucket").distinct(), "family-buckets")
        family = settled(in_split.join(families, "bucket", "left_semi").select("id", "comp", "part").distinct(), "family-classes")
        small = in_split.join(families, "bucket", "left_anti").select("bucket", "id", "comp", "part", F.lit(EITHER).alias("side"), F.lit(True).alias("banded"))
        dealt = small.unionByName(self._dealt_by_rarity(family.select("id")).join(family, "id").withColumn("banded", F.lit(False)))
        dealt = settled(dealt, "dealt-classes")

        shares = dealt.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"), F.min("side").alias("least"), F.max("side").alias("most"))
        both_sides = (F.max("most") == EITHER) | (F.min("least") != F.max("most"))
        sized = shares.groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("comps"), both_sides.alias("meet")).filter("comps > 1 and meet")
        in_blocks = lambda n: F.ceil(n / BLOCK).cast("int")
        sized = sized.select("bucket", F.col("top.comp").alias("top"), in_blocks(F.col("n")).alias("blocks"), in_blocks(F.col("n") - F.col("top.c")).alias("probes"))
        mixed = dealt.join(settled(sized, "mixed-buckets"), "bucket").withColumn("probing", F.col("comp") != F.col("top"))
        # A block of probes meets every block of members, so that neither is held or read in a larger piece.
        own_block = lambda n: F.pmod(F.xxhash64("id"), n).cast("long")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
        shape = ["bucket", "id", "comp", "part", "probing", "side", "banded"]
        probes = mixed.filter("probing").withColumn("_member_block", every(F.col("blocks")))
        probes = probes.select(*shape, (own_block(F.col("probes")) * F.col("blocks") + F.col("_member_block")).alias("block"), F.lit(0).alias("role"))
        rest = mixed.withColumn("_probe_block", every(F.col("probes")))
        rest = rest.select(*shape, (F.col("_probe_block") * F.col("blocks") + own_block(F.col("blocks"))).alias("block"), F.lit(1).alias("role"))
        rows = probes.unionByName(rest).join(self.classes.select("id", "sketch", "bands"), "id")
        rows = rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "role")
        found = rows.mapInArrow(_candidates(needed), "probe long, comp long, part long, members array<long>")
        found = settled(found.groupBy("probe", "comp", "part").agg(F.array_distinct(F.flatten(F.collect_list("members"))).alias("members")), "probes")

        none = F.lit(None).cast("array<long>")
        parts = settled(found.select("comp", "part").distinct(), "probed-parts")
        wanted = nodes.join(parts, ["comp", "part"]).select("id", "comp", "part", F.lit(0).alias("role"), none.alias("members"))
        wanted = wanted.union(found.select("probe", "comp", "part", F.lit(1), "members"))
        ordered = self._texts_of(wanted).repartition("comp", "part").sortWithinPartitions("comp", "part", "role")
        ordered = ordered.select("comp", "part", "role", "id", "members", "text")
        return settled(ordered.mapInArrow(_connected(self.size, self.percent), "a long, b long"), "links")

    def _dealt_by_rarity(self, wanted: DataFrame) -> DataFrame:
        """(bucket, side, id): the wanted classes by their rare keys. The driver holds the counters, of which there is a fixed number."""
        texts = settled(self._texts_of(wanted), "family-texts")
        met = texts.mapInArrow(_counted(self.size), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(COUNTERS, np.int64)
        counts[met.column("slot").to_numpy()] = met.column("n").to_numpy()
        return texts.mapInArrow(_dealt_by_rarity(counts, self.size, self.percent), "bucket long, side int, id long")

    def groups(self) -> DataFrame:
        """(doc_id, doc, n_shingles, component_id, component, kept) for each document.

        ``component_id`` is the smallest id of the group, ``kept`` whether it is
        the document's own. ``component`` names the group even where ids are
        null or repeated; a document without shingles has none.
        """
        comps = components(self.links())
        of_class = self.classes.select("id", "digest").join(comps, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("comp", "id").alias("component"))
        rows = self.rows.select("doc_id", "doc", "n_shingles", "digest").join(of_class, "digest", "left")
        rows = settled(rows.drop("digest"), "grouped")
        least = settled(rows.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("least")), "smallest-ids")
        rows = rows.join(least, "component", "left").withColumn("component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")))
        return rows.select("doc_id", "doc", "n_shingles", "component_id", "component", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of links (a, b): comp is the smallest node reachable.

    Each round hangs the larger neighbours of a node, then the smaller ones and
    itself, under its smallest neighbour, until nothing changes.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = settled(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select("v", "v").distinct())
        before = state
        both = edges.union(edges.select("v", "u"))
        least = settled(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "smallest")
        large = both.filter("v > u").join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "large-star")
        down = settled(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        small = large.join(down, "u").select(F.explode(F.array_distinct(F.array("u", "v"))).alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        edges = settled(small, "edges")


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, of each group the one with the smallest id, and all without words.

    Of several rows with that id and text, or with a null id, one stays.
    """
    (doc,) = free_names(docs, "_doc")
    rows = NearDuplicates(docs, size, percent, id_col, text_col).groups()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc"))
    one = rows.filter(F.col("component").isNotNull()).groupBy("component").agg(first.alias("first")).select(F.col("first.doc").alias(doc))
    grouped = docs.withColumn(doc, identity(F.col(id_col), F.col(text_col)))
    has_words = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    kept = grouped.filter(has_words).dropDuplicates([doc]).join(one, doc, "left_semi")
    return kept.unionByName(grouped.filter(F.coalesce(~has_words, F.lit(True)))).select(*docs.columns)
