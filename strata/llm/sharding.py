"""Sharding by Hilbert-curve order.

Language, source and size are quantised to 32 bins each; the cells of this cube
are put on a Hilbert curve, the rows numbered along it, and the run cut into
shards whose counts differ by one at most. Neighbouring rows agree in most
dimensions, so files cut from a shard can be skipped by the bins they hold.

Rows are dealt over tasks by ranges of the curve, of the digests of their values
and of chance, sorted there and written once with their place in the task; a
row's number is its place plus the rows of the tasks before. No cell and no
group of equal rows is held together: a third of all rows in one cell, or equal
in all columns, goes over as many tasks as other rows do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.shared import free_names, identity, marked
from strata.session import settled

BITS = 5
DIMS = 3
#: Bits of a place that number the rows of a task; the others number the tasks.
TASK_BITS = 33

#: By the three bits that a level adds, in Gray code order: where the curve enters the octant and along which axis.
_GRAY = [w ^ (w >> 1) for w in range(8)]
_RANK = [_GRAY.index(b) for b in range(8)]
_ENTRY = [0 if w == 0 else _GRAY[2 * ((w - 1) // 2)] for w in range(8)]


def _trailing_ones(w: int) -> int:
    return 0 if w % 2 == 0 else 1 + _trailing_ones(w // 2)


_AXIS = [0 if w == 0 else _trailing_ones(w if w % 2 else w - 1) % DIMS for w in range(8)]


def hilbert_index(bins: list[Column]) -> Column:
    """Place of the cell (three bins below 32) on the curve, from 0."""
    table = lambda values: F.array(*[F.lit(v) for v in values])
    cell = F.struct(*[value.cast("int").alias(f"d{k}") for k, value in enumerate(bins)])

    def level(state: Column, bit: Column) -> Column:
        def turned(value: Column, by: Column) -> Column:
            """Three bits rotated right."""
            return (F.call_function("shiftright", value, by)).bitwiseOR(F.call_function("shiftleft", value, F.lit(DIMS) - by)).bitwiseAND(F.lit(7))

        taken = [F.call_function("shiftright", state["cell"][f"d{k}"], bit).bitwiseAND(F.lit(1)) for k in range(DIMS)]
        corner = taken[0].bitwiseOR(F.call_function("shiftleft", taken[1], F.lit(1))).bitwiseOR(F.call_function("shiftleft", taken[2], F.lit(2)))
        rank = F.get(table(_RANK), turned(corner.bitwiseXOR(state["entry"]), (state["axis"] + 1) % DIMS))
        back = (F.lit(DIMS) - (state["axis"] + 1) % DIMS) % DIMS
        return F.struct(
            state["cell"].alias("cell"),
            (state["index"] * 8 + rank).alias("index"),
            state["entry"].bitwiseXOR(turned(F.get(table(_ENTRY), rank), back)).alias("entry"),
            ((state["axis"] + F.get(table(_AXIS), rank) + 1) % DIMS).alias("axis"),
        )

    start = F.struct(cell.alias("cell"), F.lit(0).alias("index"), F.lit(0).alias("entry"), F.lit(0).alias("axis"))
    return F.aggregate(table(reversed(range(BITS))), start, level, lambda state: state["index"])


def category_bin(value: Column) -> Column:
    """Bin of a name, by hash; null has one of its own."""
    return F.conv(F.substring(F.md5(marked(value)), 1, 2), 16, 10).cast("int") % (1 << BITS)


def size_bin(size: Column) -> Column:
    """Bin of a size by its power of two."""
    return F.least(F.length(F.bin(size)) - 1, F.lit((1 << BITS) - 1))


def text_size(text: Column) -> Column:
    """Bytes of the text, none for null, plus eight."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def numbered(rows: DataFrame, cell: str, digest: str, number: str) -> tuple[DataFrame, int]:
    """The rows with a gapless number from 0 in the order of cell and digest, and how many there are.

    Rows equal in both take any order. Whole rows move once and are written
    once, so that a repeated step gives the same numbers; the counts of the tasks
    are all that is broadcast, a row for each partition of the shuffle.
    """
    kept = rows.columns
    chance, place, task, n = free_names(rows, "_chance", "_place", "_task", "_n")
    dealt = rows.withColumn(chance, F.rand(7)).repartitionByRange(cell, digest, chance).sortWithinPartitions(cell, digest)
    run = settled(dealt.select(*kept).withColumn(place, F.monotonically_increasing_id()), "curve-run")
    of_task = F.shiftright(place, TASK_BITS)
    earlier = Window.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    per_task = settled(run.groupBy(of_task.alias(task)).agg(F.count(F.lit(1)).alias(n)), "curve-tasks")
    total = per_task.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    firsts = per_task.select(task, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n))
    numbers = (F.col(n) + F.col(place).bitwiseAND(F.lit((1 << TASK_BITS) - 1))).cast("long")
    return run.withColumn(task, of_task).join(F.broadcast(firsts), task).select(*kept, numbers.alias(number)), total


def shard_of(number: Column, total: int, shards: int) -> tuple[Column, Column]:
    """Shard of a row number, and its slot there; counts differ by one at most."""
    large, small = total % shards, total // shards  # the first shards have a row more
    cut = large * (small + 1)
    shard = F.when(number < cut, F.floor(number / F.lit(small + 1))).otherwise(large + F.floor((number - cut) / F.lit(max(small, 1)))).cast("int")
    first = shard * small + F.least(shard, F.lit(large))
    return shard, (number - first).cast("long")


def curve_of(text: Column, lang: Column, source: Column) -> Column:
    return hilbert_index([category_bin(source), category_bin(lang), size_bin(text_size(text))])


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents with ``shard``, ``slot`` and ``curve``, under free names where these are taken.

    The counts of two shards differ by one at most, so there are empty shards
    only where rows are fewer than shards. A null language or source is a name
    of its own, a null text has no bytes, and repeated rows each get a slot.
    """
    shard, slot, curve, doc, number = free_names(docs, "shard", "slot", "curve", "_doc", "_number")
    on_curve = curve_of(F.col(text_col), F.col(lang_col), F.col(source_col))
    rows = docs.withColumns({doc: identity(F.col(id_col), F.col(text_col)), curve: on_curve})
    rows, total = numbered(rows, curve, doc, number)
    of, at = shard_of(F.col(number), total, shards)
    return rows.select(*docs.columns, of.alias(shard), at.alias(slot), curve)


def placements(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) for each row of the documents.

    The law is ``rows``: ``grown_shard`` is null. A null text is an empty one,
    with checksum 0. Texts are measured where they are read and do not move, and any number of equal rows is numbered like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        text_size(text).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        identity(F.col("doc_id"), text).alias("doc"),
        curve_of(text, F.col("lang"), F.col("source")).alias("curve"),
    )
    rows, total = numbered(rows, "curve", "doc", "number")
    shard, slot = shard_of(F.col("number"), total, shards)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")
