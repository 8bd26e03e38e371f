"""Line deduplication by a range-partitioned stream of line hashes.

Lines become (hash, document, position) rows, which are range-partitioned and
sorted by exactly these columns. A line that fills a third of the corpus is thus
spread over many partitions, each of which reads its part as a stream. Only the
first and the last hash of a partition can go on in another one; their counts,
at most two per partition, are added up and handed back. What comes out is one
compressed bitmap per document that loses lines; no text moves before the
bitmaps are applied.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import SPACE_BYTES, identity
from strata.session import settled

#: Rows of one Arrow batch that a stream gives on.
BATCH = 20_000


def line_key(line: bytes) -> bytes:
    """The line without outer white space, A-Z in lower case."""
    return line.strip(SPACE_BYTES).lower()


def _hashed_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows):
        hashes, ids, docs, places = zip(*rows)
        return pa.record_batch(
            [pa.array(hashes, pa.binary()), pa.array(ids, id_type), pa.array(docs, pa.binary()), pa.array(places, pa.int32())],
            names=["hash", "id", "doc", "place"],
        )

    for batch in batches:
        id_type, rows = batch.column(0).type, []
        for owner, doc, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            owner, doc = owner.as_py(), doc.as_py()
            for place, line in enumerate((text.as_py() or b"").split(b"\n")):
                if key := line_key(line):
                    rows.append((blake2b(key, digest_size=16).digest(), owner, doc, place))
            if len(rows) >= BATCH:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes, int]]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in ("hash", "doc", "place")), strict=True)


def _border_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the first and of the last hash of this partition."""
    borders: list[list] = []
    current = doc = None
    for key, owner, _ in _rows(batches):
        if key != current:
            current, doc = key, None
            if len(borders) < 2:
                borders.append([key, 0])
            else:
                borders[1] = [key, 0]
        if owner != doc:
            doc = owner
            borders[-1][1] += 1
    if borders:
        part = TaskContext.get().partitionId()
        yield pa.record_batch(
            [pa.array([b[0] for b in borders], pa.binary()), pa.array([b[1] for b in borders], pa.int64()), pa.array([part] * len(borders), pa.int32())],
            names=["hash", "docs", "part"],
        )


def _dropped(totals: dict[bytes, tuple[int, int]], min_docs: int, spare_first: bool):
    def stream(rows, part: int) -> Iterator[tuple[bytes, int]]:
        """Lines to drop. A hash is undecided until min_docs of its documents went by."""
        current = doc = None
        docs, waiting, decided = 0, [], False
        for key, owner, place in rows:
            if key != current:
                current, doc, docs, waiting = key, None, 0, []
                total, first_part = totals.get(key, (0, part))
                decided = total >= min_docs
                if spare_first and first_part == part:
                    doc, docs = owner, 1
                    continue
            if owner != doc:
                doc, docs = owner, docs + 1
                if docs >= min_docs and not decided:
                    decided = True
                    yield from waiting
                    waiting = []
            if decided:
                yield owner, place
            elif current not in totals:
                waiting.append((owner, place))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows):
            return pa.record_batch(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())], names=["doc", "place"]
            )

        rows = []
        for row in stream(_rows(batches), TaskContext.get().partitionId()):
            rows.append(row)
            if len(rows) >= BATCH:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)

    return apply


def pack_bitmap(dropped: list[int]) -> bytes:
    """Keep bits up to the last dropped line, compressed; later lines are kept."""
    bits = np.ones(max(dropped) + 1, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes() + len(bits).to_bytes(8, "little"))


def unpack_bitmap(bitmap: bytes | None, lines: int) -> np.ndarray:
    keep = np.ones(lines, bool)
    if bitmap is not None:
        raw = zlib.decompress(bitmap)
        bits = np.unpackbits(np.frombuffer(raw[:-8], np.uint8))[: int.from_bytes(raw[-8:], "little")]
        keep[: len(bits)] = bits.astype(bool)
    return keep


def kept_lines(text: bytes | None, bitmap: bytes | None) -> tuple[int, list[bytes]]:
    """Number of lines of a text, and those that its bitmap keeps."""
    lines = (text or b"").split(b"\n")
    if bitmap is None:
        return len(lines), lines
    return len(lines), [line for line, keep in zip(lines, unpack_bitmap(bitmap, len(lines)), strict=True) if keep]


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, spare_first: bool = False
) -> DataFrame:
    """One row (doc, bitmap) for each document that loses lines.

    ``doc`` is ``identity(id, text)``. A document is a distinct pair of id and
    text: repeated rows count once and share a bitmap, a null id is an id like
    any other. A line whose key is found in ``min_docs`` documents or more loses
    all its occurrences, or all but the first one by (id, document, position)
    with ``spare_first``. Lines without a key (empty, or white space only) always
    stay. A null text is one empty line. Other columns are not looked at.
    """
    lines = settled(
        docs.select(F.col(id_col).alias("id"), identity(F.col(id_col), F.col(text_col)).alias("doc"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
            _hashed_lines,
            T.StructType(
                [T.StructField("hash", T.BinaryType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("doc", T.BinaryType()), T.StructField("place", T.IntegerType())]
            ),
        ),
        "lines",
    )
    # The bounds of a range partitioning are drawn anew by each job; the checkpoint holds the parts fast.
    order = ["hash", "id", "doc", "place"]
    parts = shared_checkpoint(lines.repartitionByRange(*order[:3]).sortWithinPartitions(*order))
    borders = (
        parts.mapInArrow(_border_counts, "hash binary, docs long, part int")
        .groupBy("hash")
        .agg(F.sum("docs").alias("docs"), F.min("part").alias("part"))
    )
    totals = {bytes(row["hash"]): (row["docs"], row["part"]) for row in borders.collect()}  # two per partition at most
    dropped = parts.mapInArrow(_dropped(totals, min_docs, spare_first), "doc binary, place int")

    @F.pandas_udf("binary")
    def packed(places):
        return places.map(lambda dropped: pack_bitmap(np.asarray(dropped, np.int64)))

    return dropped.groupBy("doc").agg(F.collect_set("place").alias("places")).select("doc", packed("places").alias("bitmap"))


def shared_checkpoint(rows: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names, in one of its own where none is named."""
    from strata.session import work_folder

    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(rows.sparkSession.conf.get("spark.checkpoint.dir", None) or work_folder(rows.sparkSession, "checkpoint"))
    return rows.checkpoint()


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text as bytes, bitmap) for each row of the documents."""
    return (
        docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"), identity(F.col(id_col), F.col(text_col)).alias("doc"))
        .join(bitmaps, "doc", "left")
        .select(id_col, "text", "bitmap")
    )
