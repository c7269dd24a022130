"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import io
import os
import pathlib
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from reelhouse.sources import commits

# Runtime settings every plan in this package expects.  All of them can be
# changed on a live session, so they are safe on a cluster the caller owns.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffle files go when the query that wrote them has ended.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark.sparkContext)
    return spark


def ship_package(sc: SparkContext) -> None:
    """Send this package to the executors, once per application.

    Python workers import it by name, and only the driver has it on its path.
    """
    if sc.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    # The driver serves the file to executors for as long as the application runs.
    handle, path = tempfile.mkstemp(prefix="reelhouse-", suffix=".zip")
    with os.fdopen(handle, "wb") as out:
        out.write(packed.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reelhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see, as the cluster names it.

    A machine-local folder is only ever used in local mode, where the driver is
    the executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="reelhouse-")
    return _local_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Bytes of compressed columns behind one shuffle partition, and a partition's size after coalescing.
BYTES_PER_PARTITION = 2 << 20
COALESCED_BYTES = 16 << 20
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_COALESCED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def widen(spark: SparkSession, input_bytes: int) -> None:
    """Deal shuffles of a table of this size to so many partitions that a task's share needs no spill.

    Adaptive execution coalesces what is small after all, to `COALESCED_BYTES`: rows grow several times when they are
    uncompressed. The number is only ever raised.
    """
    now = int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    if wanted > now:
        spark.conf.set(_PARTITIONS, str(wanted))
    spark.conf.set(_COALESCED, str(COALESCED_BYTES))


_scratch = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside the block is removed at its end, for steps that leave nothing lazy behind.

    A stream stages anew for every batch, so without this its folders would add up.
    """
    outer = getattr(_scratch, "paths", None)
    _scratch.paths = paths = []
    try:
        yield
    finally:
        _scratch.paths = outer
        for path in paths:
            commits.remove(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back.

    Columnar and compressed, and a lost executor costs no replay of what came before.
    """
    path = run_dir(df.sparkSession, label)
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joinable(aggregate: DataFrame) -> DataFrame:
    """An aggregate about to be joined with the rows it was made from.

    Adaptive execution splits a hot key of a join only where a shuffle lies directly below both sides. An aggregate made in
    the stage of the join stands between, and keeps a key with a third of all rows in one task; so it is written first.
    """
    return staged(aggregate, "aggregate")


def unbroadcast(side: DataFrame) -> DataFrame:
    """A side of a join over rows of any number: the driver is never to hold them.

    Ids compress to a fraction of what they take as rows, so a file that seems small enough to send around may not be.
    """
    return side.hint("merge")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, so a lost executor costs no replay."""
    return staged(df, "cut")
