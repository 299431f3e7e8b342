"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every query relies on. Sizes (shuffle partitions, broadcast threshold, executor
# memory) belong to the deployment and are left alone: AQE coalesces small partitions and splits large ones.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order or sku may be followed by an aggregate on the same key. Splitting it is then worth the
    # extra shuffle, which AQE adds only when a partition really is skewed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compressed files unpack to several times their size: weigh a scan by that before broadcasting it.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "orderloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_LOCAL_CHECKPOINTS = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for the streams started inside, which copy them; those of the session are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Files of kept state are packed more closely than by default, for about the same processor time.
PACKED_STATE = {"spark.sql.streaming.stateStore.compression.codec": "zstd"}


def checkpoint_settings(spark: SparkSession, checkpoint: str) -> dict[str, str]:
    """Settings for a stream with this checkpoint. On ``file:`` paths Spark's usual file manager starts several processes for every file it writes, and
    each partition of each state store writes files in every batch; renames through the plain file system start none and are as atomic there. Other
    file systems, and sessions that name a manager, keep theirs."""
    key = "spark.sql.streaming.checkpointFileManagerClass"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    scheme = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    return {key: _LOCAL_CHECKPOINTS} if scheme == "file" and not spark.conf.get(key, None) else {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="orderloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
