"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "strata") -> SparkSession:
    """Session for tests and benchmarks on one machine.

    On a cluster the caller brings the session; nothing in the package changes
    its configuration.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.openCostInBytes", "1048576")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh folder for tables this run writes.

    It lies under ``spark.checkpoint.dir``, which every executor of a cluster
    can reach. Only a local master may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="strata-")
    return f"{shared.rstrip('/')}/strata/{purpose}-{uuid.uuid4().hex}"


def settled(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written once to the shared folder and read from there.

    For input that several steps use and that need not give the same rows twice,
    such as a database: every later step, also a repeated one, sees what was
    written, and a lost executor costs no second extract.
    """
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def extracted(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Settled rows for as long as they are needed; the folder goes after it."""
    spark = rows.sparkSession
    path = work_folder(spark, purpose)
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
