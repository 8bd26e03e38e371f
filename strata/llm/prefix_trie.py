"""Prefix trie of conversations in balanced parentheses.

A node is a distinct sequence of first turns. Its members share the hash of the
prefix, a sum of turn hashes, which rolls on through blocks of turns, so that a
conversation of any length goes over many tasks. A node is named by its smallest
member, its owner, and its depth. The nodes that a conversation owns are the
lower end of its path, a spine; where the spine is hung up, and on which spine,
orders all nodes depth first, without a walk.

The nodes are range-partitioned in this order. Each shard writes its part of the
trie as balanced parentheses: an opening one where a node begins, a closing one
where its subtree ends. Blocks of the excess (openings less closings) with their
least and greatest values lead from an opening parenthesis to the one that closes
it, which delimits the subtree; ranks of "()" count its leaves, cumulative sums
over the openings its savings. Nodes whose subtree goes on in later shards are the
spines that these share. They are few per shard and are completed from totals
per shard, and from what the shard in which they end holds before their end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.ordering import placed, tie_order
from strata.llm.shared import shuffle_partitions, words
from strata.session import settled

#: Turns of a block of a conversation.
BLOCK_TURNS = 1024
#: Nodes of a shard, about.
SHARD_NODES = 1 << 18
#: Parentheses of a block of excess.
BLOCK_BITS = 256
#: Width of the pieces that a node's list of ids is put together from, in ids.
PIECE_IDS = 4096


# --- turns and prefixes ---


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, t1, t2, words): turns numbered from 1, by two hashes of role and text.

    Turns are ordered by ``turn``, null first, those of the same number as
    ``tie_order`` says. A null role or text is empty. Turns without a conversation
    id are of no conversation.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    slim = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.xxhash64(F.lit(1), F.length(role), role, text).alias("t1"),
        F.xxhash64(F.lit(2), F.length(role), role, text).alias("t2"),
        F.size(words(text)).cast("long").alias("words"),
        F.col("turn").alias("_turn"),
        *[value.alias(name) for name, value in tie_order(role, text).items()],
    )
    rows = placed(slim, "conv_id", ["_turn", "_role", "_text", "_digest"], "ordered-turns")
    block = F.floor(F.col("place") / BLOCK_TURNS)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Places of a conversation have no gaps within a block, so a block's first place and the turns before it number its rows.
    blocks = (
        rows.groupBy("conv_id", block.alias("block"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("place").alias("first"))
        .select("conv_id", "block", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    )
    return rows.withColumn("block", block).join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("before") + F.col("place") - F.col("first") + 1).alias("n"), "t1", "t2", "words")


def prefixes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, words, is_end): each prefix of each member, the empty one included.

    ``turns`` has (conv_id, n, t1, t2, words), ``members`` (conv_id, length), one
    row for each conversation. p1 and p2 name the prefix together with its depth;
    words are those of its last turn.
    """
    zero = F.lit(0).cast("decimal(38,0)")
    hashed = turns.select(
        "conv_id",
        F.col("n").alias("depth"),
        F.floor(F.col("n") / BLOCK_TURNS).alias("block"),
        *[F.xxhash64(F.lit(seed), "n", "t1", "t2").cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)],
        "words",
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        hashed.groupBy("conv_id", "block")
        .agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"), F.max("depth").alias("last"))
        .select(
            "conv_id",
            "block",
            F.coalesce(F.sum("s1").over(before), zero).alias("b1"),
            F.coalesce(F.sum("s2").over(before), zero).alias("b2"),
            F.max("last").over(Window.partitionBy("conv_id")).alias("length"),
        )
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = hashed.withColumns({"r1": F.sum("h1").over(so_far), "r2": F.sum("h2").over(so_far)})
    rows = rolled.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "depth",
        (F.col("b1") + F.col("r1")).cast("decimal(38,0)").alias("p1"),
        (F.col("b2") + F.col("r2")).cast("decimal(38,0)").alias("p2"),
        "words",
        (F.col("depth") == F.col("length")).alias("is_end"),
    )
    roots = members.select("conv_id", F.lit(0).cast("long").alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(0).cast("long").alias("words"), (F.col("length") == 0).alias("is_end"))
    return rows.unionByName(roots)


# --- balanced parentheses of a shard ---


class Parentheses:
    """A run of nodes, given by their depths in depth-first order, as balanced parentheses.

    ``closed_last`` tells whether the last node is a leaf. A node that the run
    does not end stays open; closings of nodes before the run are left out.
    """

    def __init__(self, depths: np.ndarray, closed_last: bool):
        n = len(depths)
        closings = np.empty(n, np.int64)
        closings[:-1] = np.maximum(depths[:-1] - depths[1:] + 1, 0)
        closings[-1] = int(closed_last)
        # Open nodes after each one; below none are closed, hence the reflection at zero.
        free = np.cumsum(1 - closings)
        left = free - np.minimum(np.minimum.accumulate(free), 0)
        closings = np.diff(left, prepend=0) * -1 + 1
        self.opens = np.arange(n) + np.concatenate([[0], np.cumsum(closings)[:-1]])
        self.bits = np.full(n + int(closings.sum()), -1, np.int8)
        self.bits[self.opens] = 1
        self.excess = np.cumsum(self.bits, dtype=np.int64)
        pair = np.zeros(len(self.bits) + 1, np.int64)
        pair[1:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == -1)
        #: Number of pairs "()" that begin before a place.
        self.pairs = np.cumsum(pair)
        self._tree()

    def _tree(self) -> None:
        """Least and greatest excess of blocks, then of pairs of blocks, up to one."""
        blocks = -(-len(self.bits) // BLOCK_BITS)
        padded = np.full(blocks * BLOCK_BITS, self.excess[-1])
        padded[: len(self.excess)] = self.excess
        cut = padded.reshape(blocks, BLOCK_BITS)
        self.least, self.greatest = [cut.min(1)], [cut.max(1)]
        while len(self.least[-1]) > 1:
            low, high = self.least[-1], self.greatest[-1]
            if len(low) % 2:
                low, high = np.append(low, low[-1]), np.append(high, high[-1])
            self.least.append(low.reshape(-1, 2).min(1))
            self.greatest.append(high.reshape(-1, 2).max(1))

    def find_close(self, place: int) -> int:
        """Place of the parenthesis that closes the opening one at ``place``; the length where none does."""
        wanted = self.excess[place] - 1
        block = place // BLOCK_BITS
        inside = self.excess[place + 1 : (block + 1) * BLOCK_BITS] == wanted
        if inside.any():
            return place + 1 + int(inside.argmax())
        level, at = 0, block + 1
        while True:  # up, until a range on the right holds the wanted excess
            if at >= len(self.least[level]):
                return len(self.bits)
            if self.least[level][at] <= wanted <= self.greatest[level][at]:
                break
            if at % 2 == 0:
                at += 1
                if at < len(self.least[level]) and self.least[level][at] <= wanted <= self.greatest[level][at]:
                    break
            level, at = level + 1, (at + 1) // 2
            if level >= len(self.least):
                return len(self.bits)
        while level:  # down, to the first block that holds it
            level, at = level - 1, at * 2
            if not self.least[level][at] <= wanted <= self.greatest[level][at]:
                at += 1
        start = at * BLOCK_BITS
        return start + int((self.excess[start : start + BLOCK_BITS] == wanted).argmax())

    def subtrees(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaves and sum of weights in each node's subtree, as far as the run holds it, and whether it ends there."""
        summed = np.concatenate([[0], np.cumsum(weights)])
        closes = np.fromiter((self.find_close(int(p)) for p in self.opens), np.int64, len(self.opens))
        ends = closes < len(self.bits)
        nodes = np.where(ends, (closes - self.opens + 1) // 2, len(self.opens) - np.arange(len(self.opens)))
        return self.pairs[closes] - self.pairs[self.opens], summed[np.arange(len(nodes)) + nodes] - summed[:-1], ends


NODE, BORDER, SHARD = 0, 1, 2
_SHARDED = "kind int, shard int, conv_id long, depth long, ends boolean, n_leaves long, saved_tokens long, first long"


def _encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a shard's (conv_id, depth, weight, leaf) in order: its nodes, its borders and its totals.

    A border is a node above all before it: ``n_leaves`` and ``saved_tokens`` are
    those of the shard before it, which belong to nodes of earlier shards.
    """
    held = [[batch.column(name).to_numpy(zero_copy_only=False) for name in ("conv_id", "depth", "weight", "leaf")] for batch in batches if len(batch)]
    if not held:
        return
    own, depth, weight, leaf = (np.concatenate(column) for column in zip(*held, strict=True))
    shard = TaskContext.get().partitionId()
    written = Parentheses(depth, bool(leaf[-1]))
    leaves, saved, ends = written.subtrees(weight)
    summed = np.concatenate([[0], np.cumsum(weight)])
    lowest = np.minimum.accumulate(depth)
    border = np.flatnonzero(depth[1:] < lowest[:-1]) + 1

    def rows(kind, own, depth, ends, leaves, saved, first):
        n = len(depth)
        columns = [np.full(n, kind, np.int32), np.full(n, shard, np.int32), own, depth, ends, leaves, saved, first]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "shard", "conv_id", "depth", "ends", "n_leaves", "saved_tokens", "first"])

    none = np.zeros(len(own), np.int64)
    yield rows(NODE, own, depth, ends, leaves, saved, none)
    before = written.pairs[written.opens[border]]
    yield rows(BORDER, own[border], depth[border], np.ones(len(border), bool), before, summed[border], none[border])
    one = np.array([0], np.int64)
    yield rows(SHARD, one, lowest[-1:], np.ones(1, bool), written.pairs[-1:], summed[-1:], depth[:1])


def _ended_in(totals: list):
    """For open nodes (shard, conv_id, depth, ...): the shard in which they end, with the sums of those between."""
    at = np.array([row["shard"] for row in totals], np.int64)
    lowest, first, leaves, saved = (np.array([row[name] for row in totals], np.int64) for name in ("depth", "first", "n_leaves", "saved_tokens"))
    leaves_before, saved_before = (np.concatenate([[0], np.cumsum(values)]) for values in (leaves, saved))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, conv, depth, own_leaves, own_saved = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("shard", "conv_id", "depth", "n_leaves", "saved_tokens"))
            end = np.empty(len(shard), np.int64)
            place = np.searchsorted(at, shard)
            for k in np.unique(place):
                here = place == k
                fallen = np.minimum.accumulate(lowest[k + 1 :])
                end[here] = k + 1 + np.searchsorted(-fallen, -depth[here], side="left")
            more_leaves = own_leaves + leaves_before[end] - leaves_before[place + 1]
            more_saved = own_saved + saved_before[end] - saved_before[place + 1]
            # A shard whose first node is not below this one adds nothing.
            inside = (end < len(at)) & (depth < np.append(first, -1)[end])
            until = np.where(inside, np.append(at, -1)[end], -1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (until.astype(np.int32), conv, depth, more_leaves, more_saved)], names=["until", "conv_id", "depth", "n_leaves", "saved_tokens"])

    return apply


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of nodes (key, conv_id, depth, weight, leaf).

    ``key`` and ``depth`` order the nodes depth first. A shard has ``SHARD_NODES``
    nodes or fewer, about; the driver holds one row per shard.
    """
    spark = nodes.sparkSession
    shards = max(shuffle_partitions(spark), -(-nodes.count() // SHARD_NODES))
    dealt = nodes.repartitionByRange(shards, "key", "depth").sortWithinPartitions("key", "depth")
    rows = settled(dealt.select("conv_id", "depth", "weight", "leaf").mapInArrow(_encoded, _SHARDED), "parentheses")
    sums = ["conv_id", "depth", "n_leaves", "saved_tokens"]
    totals = rows.filter(F.col("kind") == SHARD).orderBy("shard").collect()
    whole = rows.filter((F.col("kind") == NODE) & F.col("ends")).select(*sums)
    open_ = rows.filter((F.col("kind") == NODE) & ~F.col("ends")).select("shard", *sums)
    open_ = settled(open_.mapInArrow(_ended_in(totals), "until int, conv_id long, depth long, n_leaves long, saved_tokens long"), "open-nodes")
    done = open_.filter("until = -1").select(*sums)
    # What the last shard holds before its first node that is not below: that of the highest border at or above the depth.
    border = rows.filter(F.col("kind") == BORDER).select(F.col("shard").alias("until"), "depth", F.lit(0).alias("order"), F.struct("n_leaves", "saved_tokens").alias("before"))
    asking = open_.filter("until >= 0").select("until", "depth", F.lit(1).alias("order"), F.lit(None).cast(border.schema["before"].dataType).alias("before"), *[F.col(n).alias(f"_{n}") for n in ("conv_id", "n_leaves", "saved_tokens")])
    upwards = Window.partitionBy("until").orderBy("depth", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = border.unionByName(asking, allowMissingColumns=True).withColumn("met", F.last("before", ignorenulls=True).over(upwards)).filter("order = 1")
    rest = met.select(F.col("_conv_id").alias("conv_id"), "depth", *[(F.col(f"_{n}") + F.col(f"met.{n}")).alias(n) for n in ("n_leaves", "saved_tokens")])
    return whole.unionByName(done).unionByName(rest)


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, from rows sorted by node and piece."""
    at, digest = None, None

    def made(rows):
        conv, depth, hashes = zip(*rows, strict=True)
        return pa.record_batch([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(hashes)], names=["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        out = []
        for conv, depth, ids in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "depth", "ids")), strict=True):
            if (conv, depth) != at:
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (conv, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield made(out)
    if at is not None:
        yield made([(*at, digest.hexdigest())])


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, n_ends, ends_sha256) per node.

    ``turns`` are the members' turns (conv_id, n, t1, t2, words), numbered from 1,
    ``members`` all conversations (conv_id, length), turnless ones included.
    The root has depth 0 and no parent. No members give no nodes.
    """
    rows = settled(prefixes(turns, members), "prefixes")
    name = ["depth", "p1", "p2"]
    nodes = settled(
        rows.groupBy(*name).agg(
            F.min("conv_id").alias("owner"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("words").alias("words"),
            F.sum(F.col("is_end").cast("long")).alias("n_ends"),
        ),
        "nodes",
    )
    owned = rows.select("conv_id", *name, "is_end").join(nodes.select(*name, "owner"), name).select("conv_id", "depth", "owner", "is_end")
    owned = settled(owned, "owners")
    # A path changes its owner where it leaves a spine for one of a larger id; the last one is its own if it owns anything.
    runs = owned.groupBy("conv_id", "owner").agg(F.min("depth").alias("start"))
    paths = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "owner"))).alias("runs")).filter(F.col("conv_id") == F.element_at("runs", -1)["owner"])
    # Spines hung up further down come first, so that every subtree is a run of nodes.
    spines = settled(
        paths.select(
            F.col("conv_id").alias("owner"),
            F.flatten(F.transform("runs", lambda run: F.array(-run["start"], run["owner"]))).alias("key"),
            F.element_at("runs", -1)["start"].alias("start"),
            F.when(F.size("runs") > 1, F.try_element_at("runs", F.lit(-2))["owner"]).alias("above"),
        ),
        "spines",
    )
    placed_nodes = nodes.join(spines, "owner").select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("start"), F.col("owner")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        "n_ends",
        ((F.col("n_convs") - 1) * F.col("words")).alias("weight"),
        "key",
    )
    placed_nodes = settled(placed_nodes, "placed-nodes")
    children = placed_nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    placed_nodes = settled(placed_nodes.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "counted-nodes")
    sums = subtree_sums(placed_nodes.select("key", "conv_id", "depth", "weight", (F.col("n_children") == 0).alias("leaf")))
    piece = F.floor(F.col("conv_id") / PIECE_IDS)
    pieces = owned.filter("is_end").groupBy(F.col("owner"), "depth", piece.alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    pieces = pieces.withColumnRenamed("owner", "conv_id").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "piece")
    ends = pieces.select("conv_id", "depth", "ids").mapInArrow(_digested, "conv_id long, depth long, ends_sha256 string")
    nodes = placed_nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_ends").join(sums, ["conv_id", "depth"]).join(ends, ["conv_id", "depth"], "left")
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))


def taken_from_base(conv_id: Column) -> Column:
    """First turns that a rebuilt conversation takes from its base, at most."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(conversations: DataFrame, base_every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Turns and members for ``trie``: each conversation begins with turns of the one at its base.

    The base of c is c less its rest by ``base_every``, which need not exist; the
    first turns of c itself are left out, as many as it asks for, whether the
    base has them or not.
    """
    turns = settled(ordered_turns(conversations), "numbered-turns")
    lengths = settled(turns.groupBy("conv_id").agg(F.max("n").alias("own")), "lengths")
    asked, base = taken_from_base(F.col("conv_id")), F.col("conv_id") - F.col("conv_id") % base_every
    found = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("offered"))
    members = lengths.select("conv_id", "own", asked.alias("asked"), base.alias("base")).join(found, "base", "left")
    members = members.withColumn("taken", F.least("asked", F.coalesce("offered", F.lit(0))))
    members = settled(members.select("conv_id", "base", "asked", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("asked"), F.lit(0))).alias("length")), "members")
    content = ["t1", "t2", "words"]
    heads = turns.filter("n <= 3").withColumnRenamed("conv_id", "base").join(members, "base").filter("n <= taken").select("conv_id", "n", *content)
    own = turns.join(members, "conv_id").filter("n > asked").select("conv_id", (F.col("n") - F.col("asked") + F.col("taken")).alias("n"), *content)
    return heads.unionByName(own), members.select("conv_id", "length")
