"""Session helpers.

The library never owns a global session: every function takes a DataFrame or a
SparkSession.  These helpers only build a session for tests / the bench and
resolve the shared folder used to cut lineage or stage round-trip files.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str = "local[8]",
    app_name: str = "quire",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and local benchmarks.

    On a cluster, size ``spark.sql.shuffle.partitions`` to ~2-3x the total
    executor cores (AQE coalesces small ones) and keep AQE skew-join on.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The cluster's shared folder: ``spark.checkpoint.dir`` (or the context's)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    return conf_dir or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the context has a checkpoint directory.

    The cluster's ``spark.checkpoint.dir`` always wins.  Only when it is unset
    and the master is local (tests) do we create a private one.
    """
    sc = spark.sparkContext
    found = shared_dir(spark)
    if found is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        found = tempfile.mkdtemp(prefix="quire-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quire-scratch/{name}-{uuid.uuid4().hex}"


#: compression of staged and intermediate tables, which share the disk with shuffles
CODEC = "zstd"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the lineage, read by many."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows of a shuffle's task, for tables of unknown size
SHUFFLE_ROWS = 1_000_000


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, per_task: int = SHUFFLE_ROWS):
    """While it holds, shuffles have a task for every ``per_task`` of ``rows``, the session's number at least.

    For jobs that are run inside it: a task's sorts and hash tables stay bounded
    however large the input is.  AQE still merges small partitions and splits skewed ones.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = -(-rows // per_task)
    if wanted <= int(before):
        yield
        return
    spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: partitions to spread a scan over that feeds per-row work; unset: the scan's own splits
SCAN_PARTITIONS = "spark.quire.scan.partitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt round-robin over ``partitions``; as it is without a number.

    For sources with fewer splits than the cluster has cores (one unsplittable
    row group).  The number is the argument or the session's
    ``spark.quire.scan.partitions``; nothing is inferred from the input.
    """
    partitions = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(partitions) if partitions else df
