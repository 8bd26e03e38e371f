"""File drops: CSV with header or JSON lines, each file taken in exactly once.

A stream watches the landing folder and runs until the backlog is drained. Per
micro-batch every record is bound to its columns *by field name*, as text, so
files may have their columns in any order and may bring new ones:

* declared columns become STRING columns of the landed table,
* other fields are kept in the map ``_extra`` and can be exposed as columns,
* records that cannot be bound keep their raw text in ``_rescued_data``.

Text stays as delivered (``007`` is not a number here); types are applied when
the landed rows are conformed. A batch writes the folder ``_batch=<id>`` and a
repeated batch replaces it, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import declare

# Files of one micro-batch. It also bounds what the driver sees of a batch: one
# header per CSV file.
FILES_PER_BATCH = 1000
CORRUPT = "_corrupt_text"


@dataclass(frozen=True)
class Feed:
    """A kind of drop: its name, ``csv`` or ``json``, and its declared types."""

    name: str
    kind: str
    types: Mapping[str, str]

    def landed_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in self.types])
        return (
            schema.add("_extra", T.MapType(T.StringType(), T.StringType()))
            .add("_rescued_data", T.StringType())
            .add("_ingest_ts", T.TimestampType())
            .add("_source_file", T.StringType())
        )


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether the folder exists and holds a file at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return not files.load(folder).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def land(
    spark: SparkSession,
    feed: Feed,
    folder: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Take in all files not seen yet; returns the rows written, 0 for an empty folder."""
    if not has_files(spark, folder):
        return 0
    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_block_start").alias("_offset"),
        )
    )
    written: list[int] = []
    query = (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(_batch_writer(feed, target, written))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written)


def _batch_writer(
    feed: Feed, target: str, written: list[int]
) -> Callable[[DataFrame, int], None]:
    bind = csv_records if feed.kind == "csv" else json_records

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = bind(batch, feed).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").parquet(f"{target}/_batch={batch_id}")
        written.append(seen.get["rows"])

    return write


def landed(spark: SparkSession, feed: Feed, target: str) -> DataFrame:
    """Rows landed so far with their ``_batch``; none before the first batch."""
    schema = feed.landed_schema().add("_batch", T.LongType())
    try:
        rows = spark.read.schema(schema).option("basePath", target).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.select(*schema.names)


def _shape(
    rows: DataFrame,
    feed: Feed,
    field: Callable[[str], Column],
    extra: Column,
    rescued: Column,
) -> DataFrame:
    return rows.select(
        *[field(c).alias(c) for c in feed.types],
        extra.cast("map<string,string>").alias("_extra"),
        rescued.alias("_rescued_data"),
        F.current_timestamp().alias("_ingest_ts"),
        "_source_file",
    )


def json_records(batch: DataFrame, feed: Feed) -> DataFrame:
    """Bind JSON lines; nested values stay JSON text."""
    fields = F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"})
    rows = batch.where(F.trim("value") != "").withColumn("_fields", fields)
    declared = F.lit(list(feed.types))
    return _shape(
        rows,
        feed,
        lambda c: F.try_element_at("_fields", F.lit(c)),
        F.map_filter("_fields", lambda k, _: ~F.array_contains(declared, k)),
        F.when(F.col("_fields").isNull(), F.col("value")),
    )


def file_headers(batch: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Files of the batch grouped by their header: column names -> paths.

    A header is the first non-empty line of the split that starts a file. One
    short row per file reaches the driver, and a batch has a bounded number.
    """
    position = F.monotonically_increasing_id()
    first = batch.select("value", "_source_file", "_offset", position.alias("_position"))
    heads = (
        first.where((F.col("_offset") == 0) & (F.trim("value") != ""))
        .groupBy("_source_file")
        .agg(F.min_by("value", "_position").alias("_header"))
        .collect()
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in heads:
        names = tuple(name.strip() for name in next(csv.reader([row["_header"].lstrip("\ufeff")])))
        groups.setdefault(names, []).append(row["_source_file"])
    return groups


def literal(path: str) -> str:
    """The path with the signs of a file pattern taken literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def csv_records(batch: DataFrame, feed: Feed) -> DataFrame:
    """Bind CSV rows through the header of their own file; case does not tell names apart."""
    spark = batch.sparkSession
    bound = None
    for names, files in sorted(file_headers(batch).items()):
        if len({name.lower() for name in names}) < len(names):
            # Which of two equal names a cell belongs to can't be told: the lines are rescued as they are.
            empty = F.create_map().cast("map<string,string>")
            lines = batch.where(F.col("_source_file").isin(files) & (F.trim("value") != ""))
            part = _shape(lines, feed, lambda _: F.lit(None).cast("string"), empty, F.col("value"))
            bound = part if bound is None else bound.unionByName(part)
            continue
        # Cells are bound by place, so a header may have any names, also those Spark gives a meaning.
        cells = {name: f"cell_{k}" for k, name in enumerate(names)}
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*cells.values(), CORRUPT)])
        rows = (
            spark.read.schema(schema)
            .option("header", "true")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv([literal(unquote(file)) for file in files])
            .withColumn("_source_file", F.col("_metadata.file_path"))
        )
        spelled = {name.lower(): name for name in names}
        taken = {c: spelled[c.lower()] for c in feed.types if c.lower() in spelled}
        others = [c for c in names if c not in taken.values()]
        pairs = [x for c in others for x in (F.lit(c), F.col(cells[c]))]
        extra = F.create_map(*pairs) if pairs else F.create_map()
        part = _shape(
            rows,
            feed,
            lambda c, taken=taken, cells=cells: F.col(cells[taken[c]]) if c in taken else F.lit(None).cast("string"),
            extra,
            F.col(CORRUPT),
        )
        bound = part if bound is None else bound.unionByName(part)
    return spark.createDataFrame([], feed.landed_schema()) if bound is None else bound


def exposed(rows: DataFrame, *names: str) -> DataFrame:
    """Turn fields kept in ``_extra`` into columns; NULL where a file lacks them."""
    return rows.withColumns({n: F.try_element_at("_extra", F.lit(n)) for n in names})


def nested(rows: DataFrame, name: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns from paths into a nested field of ``_extra``, and ``<name>_rescued`` for what does not fit.

    ``fields`` gives column -> (path, type). The field is parsed once as VARIANT,
    so files may add members or change their types; a value that is not of the
    type is NULL and kept in the rescue column, a JSON object by column.
    """
    value = F.try_parse_json(F.try_element_at("_extra", F.lit(name)))
    rows = rows.withColumn("_nested", value)
    none = F.create_map().cast("map<string,string>")
    got, lost = {}, []
    for column, (path, kind) in fields.items():
        got[column] = F.try_variant_get("_nested", path, kind)
        there = F.try_variant_get("_nested", path, "variant")
        misfit = got[column].isNull() & there.isNotNull() & ~F.is_variant_null(there)
        text = F.coalesce(F.try_variant_get("_nested", path, "string"), F.to_json(there))
        lost.append(F.when(misfit, F.create_map(F.lit(column), text)).otherwise(none))
    kept = F.map_concat(*lost) if lost else none
    got[f"{name}_rescued"] = F.when(F.size(kept) > 0, F.to_json(kept))
    return rows.withColumns(got).drop("_nested")


def extra_names(rows: DataFrame) -> DataFrame:
    """Names of the undeclared fields that occurred."""
    return rows.select(F.explode(F.map_keys("_extra")).alias("field")).distinct()


def typed(rows: DataFrame, feed: Feed) -> DataFrame:
    """Declared columns in their types, with ``_rescued_data`` for what did not fit.

    The rescue column is a JSON object of undeclared fields and of declared ones
    whose text is not of their type, or the raw text of an unbound record.
    """
    misfit = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(),
            F.create_map(F.lit(c), F.col(c)),
        ).otherwise(F.create_map().cast("map<string,string>"))
        for c, kind in feed.types.items()
        if kind != "string"
    ]
    declared = F.lit(list(feed.types))
    present = F.map_filter(
        F.coalesce("_extra", F.create_map().cast("map<string,string>")),
        lambda k, v: v.isNotNull() & ~F.array_contains(declared, k),
    )
    lost = F.map_concat(*misfit, present) if misfit else present
    rescued = F.coalesce("_rescued_data", F.when(F.size(lost) > 0, F.to_json(lost)))
    kept = declare(rows.withColumn("_rescue", rescued).drop("_extra"), feed.types)
    return kept.withColumnRenamed("_rescue", "_rescued_data")
