"""Physical layouts of one table and what they let a reader skip."""

from __future__ import annotations

import math
from collections.abc import Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import hash_slot, interleave_bits
from strata.functions.skew import flag_hot, hot_keys

TARGET_FILE_BYTES = 128 * 1024 * 1024
RANK_BITS = 6
# The k-d split takes its cuts from at most this many rows, which reach the driver.
SAMPLED = 100_000
# Levels of cuts; files beyond 2**levels divide the leaves by the keys.
KD_LEVELS = 10
CLUSTER_POSITION = "cluster_position"


def write_small_files(rows: DataFrame, path: str, files: int, dealt: bool = False) -> None:
    """Many small files: rows dealt evenly over ``files`` writers.

    Rows that are ``dealt`` lie evenly in a multiple of ``files`` partitions already,
    as ``parts_for`` gives it, and are put together without a further shuffle.
    """
    (rows.coalesce(files) if dealt else rows.repartition(files)).write.mode("overwrite").parquet(path)


def parts_for(spark: SparkSession, files: int) -> int:
    """The least multiple of ``files`` that is no less than the session's shuffle partitions."""
    return files * max(1, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / files))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all data files; only listed, content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def compact(spark: SparkSession, source: str, path: str, target: int = TARGET_FILE_BYTES) -> int:
    """Pack small files into files near the target size; returns their number.

    Neighbouring input splits are joined without a shuffle, so every row is
    read and written exactly once and never crosses the network.
    """
    files = files_for(spark, source, target)
    spark.read.parquet(source).coalesce(files).write.mode("overwrite").parquet(path)
    return files


def quantile_rank(rows: DataFrame, column: str, bits: int) -> Column:
    """Rank 0..2**bits-1 of a value among equally filled ranges.

    The 2**bits-1 cut points are the only thing the driver fetches. They become
    a balanced tree of comparisons, which stays inside generated code.
    """
    steps = 2**bits
    number = _as_number(rows, column)
    shares = [k / steps for k in range(1, steps)]
    cuts = rows.agg(F.percentile_approx(number, shares, 10_000)).first()[0] or []
    return _ranked(number, cuts, 0)


def _ranked(number: Column, cuts: Sequence[float], base: int) -> Column:
    if not cuts:
        return F.lit(base)
    middle = len(cuts) // 2
    low = _ranked(number, cuts[:middle], base)
    high = _ranked(number, cuts[middle + 1 :], base + middle + 1)
    return F.when(number < cuts[middle], low).otherwise(high)


def _as_number(rows: DataFrame, column: str) -> Column:
    kind = rows.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "string":
        return _text_number(rows, column)
    return F.col(column).cast("double")


def _text_number(rows: DataFrame, column: str) -> Column:
    """The six bytes that follow what all values begin with, as a number in string order."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    shared = len(commonprefix([low or "", high or ""]))
    digits = F.substring(F.hex(F.substring(column, shared + 1, 6).cast("binary")), 1, 12)
    return F.conv(F.rpad(digits, 12, "0"), 16, 10).cast("double")


def _tie_break(rows: DataFrame) -> Column:
    """Spreads rows with equal clustering values over several files."""
    return F.xxhash64(*rows.columns)


def write_zorder(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Sort along a Z curve over the keys, so each file is narrow in all of them."""
    curve = interleave_bits([quantile_rank(rows, k, RANK_BITS) for k in keys], RANK_BITS)
    placed = rows.withColumn("_z", F.coalesce(curve, F.lit(-1).cast("bigint")))
    ordered = placed.repartitionByRange("_z", *keys, _tie_break(rows)).sortWithinPartitions(
        "_z", *keys
    )
    ordered.drop("_z").write.mode("overwrite").parquet(path)


def files_for(spark: SparkSession, source: str, target: int = TARGET_FILE_BYTES) -> int:
    """Files of the target size that the data of a folder fills."""
    return max(1, math.ceil(folder_bytes(spark, source) / target))


def _kd_cuts(points: list[tuple[float, ...]], levels: int) -> tuple[list[int], list[float]]:
    """Key and value of the cut at every node of a full tree, the root being node 1.

    A node cuts its points in halves by the key of its level, or by the next one
    that tells them apart. Where none does, all points go on to the right.
    """
    by, at = [0] * 2**levels, [-math.inf] * 2**levels
    held = {1: points}
    for node in range(1, 2**levels):
        inside, level = held.pop(node, []), node.bit_length() - 1
        for step in range(len(inside[0]) if inside else 0):
            key = (level + step) % len(inside[0])
            values = sorted(p[key] for p in inside)
            middle = values[len(values) // 2]
            if middle == values[0]:
                middle = next((v for v in values if v > middle), middle)
            if middle > values[0]:
                by[node], at[node] = key, middle
                break
        held[2 * node] = [p for p in inside if p[by[node]] < at[node]]
        held[2 * node + 1] = [p for p in inside if p[by[node]] >= at[node]]
    return by, at


def kd_leaf(rows: DataFrame, keys: Sequence[str], levels: int) -> Column:
    """Leaf of a row in a k-d split of equal halves, in the order of the tree; nulls are lowest."""
    numbers = [F.coalesce(_as_number(rows, k), F.lit(-math.inf)) for k in keys]
    names = [f"_{i}" for i in range(len(keys))]
    sample = rows.select(F.xxhash64(*rows.columns).alias("_chance"), *[n.alias(a) for n, a in zip(numbers, names, strict=True)])
    points = [tuple(p) for p in sample.orderBy("_chance").limit(SAMPLED).select(*names).collect()]
    by, at = _kd_cuts(points, levels)
    cut_by, cut_at = F.array(*[F.lit(k) for k in by]), F.array(*[F.lit(v) for v in at])
    values = F.array(*numbers)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(levels)) if levels else F.array().cast("array<int>"),
        F.lit(1),
        lambda node, _: node * 2 + (F.get(values, F.get(cut_by, node)) >= F.get(cut_at, node)).cast("int"),
    )


def write_kd(rows: DataFrame, path: str, keys: Sequence[str], files: int) -> None:
    """Cut the rows in halves by one key after the other, so each file is a box of nearly as many rows.

    Unlike a curve of ranks, the cuts follow how the keys occur together, and the
    number of files follows from the data. A leaf that is too large for a file, as
    all its rows have equal keys or the files are many, is divided further.
    """
    levels = min(KD_LEVELS, math.ceil(math.log2(files)))
    placed = rows.withColumn("_leaf", kd_leaf(rows, keys, levels))
    ordered = placed.repartitionByRange(files, "_leaf", *keys, _tie_break(rows)).sortWithinPartitions("_leaf", *keys)
    ordered.drop("_leaf").write.mode("overwrite").parquet(path)


def write_clustered(rows: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite"):
    """Sort by the keys and remember them in the table's column metadata."""
    for position, key in enumerate(keys):
        rows = rows.withMetadata(key, {CLUSTER_POSITION: position})
    ordered = rows.repartitionByRange(*keys, _tie_break(rows)).sortWithinPartitions(*keys)
    ordered.write.mode(mode).parquet(path)


def clustering_keys(table: DataFrame) -> list[str]:
    marked = [f for f in table.schema if CLUSTER_POSITION in f.metadata]
    return [f.name for f in sorted(marked, key=lambda f: f.metadata[CLUSTER_POSITION])]


def append_clustered(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Add a batch in the order the table declares."""
    write_clustered(rows, path, clustering_keys(spark.read.parquet(path)), mode="append")


def write_partitioned(
    rows: DataFrame, path: str, column: str, writers: int | None = None, salts: int = 64
) -> None:
    """One directory per value.

    All rows of a value go to one writer, so a directory gets one file; a value
    too large for that is spread over ``salts`` writers.
    """
    spark = rows.sparkSession
    writers = writers or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(F.col("_hot"), hash_slot(rows.columns, salts)).otherwise(F.lit(0))
    flagged = flag_hot(rows, hot_keys(rows, [column]), [column])
    placed = flagged.repartition(writers, F.col(column), spread).drop("_hot")
    placed.write.mode("overwrite").partitionBy(column).parquet(path)


def write_variants(
    rows: DataFrame,
    base: str,
    keys: Sequence[str],
    day: str,
    small_files: int = 1600,
    target: int = TARGET_FILE_BYTES,
    dealt: bool = False,
) -> dict[str, str]:
    """The same rows under six layouts, each rebuilt from scratch; name -> path.

    What the rows are made of is worked out once, for the small files. The layouts
    that look at all rows several times read the clustered one, as rows that lie
    by the keys take less room in a shuffle.
    """
    spark, schema = rows.sparkSession, rows.schema
    paths = {
        n: f"{base}/{n}" for n in ("smallfiles", "compacted", "zorder", "kd", "clustered", "partitioned")
    }
    write_small_files(rows, paths["smallfiles"], small_files, dealt)
    compact(spark, paths["smallfiles"], paths["compacted"])
    write_clustered(spark.read.schema(schema).parquet(paths["smallfiles"]), paths["clustered"], keys)
    # By the plain schema, so that no other layout passes for clustered.
    rows = spark.read.schema(schema).parquet(paths["clustered"])
    write_zorder(rows, paths["zorder"], keys)
    write_kd(rows, paths["kd"], keys, files_for(spark, paths["smallfiles"], target))
    write_partitioned(rows, paths["partitioned"], day)
    return paths


def file_sizes(table: DataFrame) -> DataFrame:
    """Rows and bytes of every data file of a table."""
    return table.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def table_stats(
    table: DataFrame, partitioned_by: Sequence[str] = ()
) -> DataFrame:
    """Files, bytes and rows of a table, with its partition and clustering columns."""
    return file_sizes(table).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("bytes").alias("size_bytes"),
        F.sum("row_count").alias("row_count"),
    ).select(
        "*",
        F.lit(",".join(partitioned_by)).alias("partition_columns"),
        F.lit(",".join(clustering_keys(table))).alias("clustering_columns"),
    )


def _met_files(table: DataFrame, ranges: dict[str, tuple[object, object]]) -> DataFrame:
    """(_file, _met): whether the value ranges of a file can meet the wanted ranges."""
    edges = []
    for c in ranges:
        edges += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")]
    per_file = table.groupBy(F.col("_metadata.file_path").alias("_file")).agg(*edges)
    meets = F.lit(True)
    for c, (low, high) in ranges.items():
        meets = meets & (F.col(f"_max_{c}") >= F.lit(low)) & (F.col(f"_min_{c}") <= F.lit(high))
    # A file without any value of a key has no row in a range of it.
    return per_file.select("_file", F.coalesce(meets, F.lit(False)).alias("_met"))


def skippable_files(table: DataFrame, ranges: dict[str, tuple[object, object]]) -> DataFrame:
    """Files whose value ranges cannot meet the wanted ranges, of all files."""
    return _met_files(table, ranges).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("_met")).alias("skippable")
    )


def pruned(table: DataFrame, ranges: dict[str, tuple[object, object]]) -> DataFrame:
    """Rows in the wanted ranges, taken only from the files that can hold them."""
    wanted = F.lit(True)
    for c, (low, high) in ranges.items():
        wanted = wanted & F.col(c).between(F.lit(low), F.lit(high))
    kept = _met_files(table, ranges).where("_met").select("_file")
    rows = table.where(wanted).withColumn("_file", F.col("_metadata.file_path"))
    return rows.join(kept, "_file", "left_semi").drop("_file")
