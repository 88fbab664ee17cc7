"""SparkSession construction and the shared-folder helpers.

The library never creates its own session inside an operator; jobs receive a
session.  ``build_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the per-symbol window stage is CPU-heavy per byte: keep post-shuffle
    # parallelism when a shuffle is small instead of coalescing it into one
    # task (large shuffles are unaffected: their partitions exceed this floor)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # files are small in tests; 128 MiB splits are right for the cluster
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "barwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that the driver and all executors
    share; it is used as is.  Only a local session (tests, bench) that leaves
    it unset gets a scratch folder; on a cluster an unset folder is an error,
    because a machine-local one would split a table over the executors' disks.
    """
    sc = spark.sparkContext
    cur = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
        cur = tempfile.mkdtemp(prefix="barwise-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Folders of the tables written inside the open ``scratch`` blocks, innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("barwise_scratch", default=())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    Cuts the lineage durably: a later stage rereads the files, whichever
    executors are lost meanwhile.  Inside a ``scratch`` block the table lives as
    long as the block, unless it is kept."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    if _open.get():
        _open.get()[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own in whichever file system holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget(table: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    delete_folder(table.sparkSession, table.written_to)
    for tables in _open.get():
        if table.written_to in tables:
            tables.remove(table.written_to)


@contextmanager
def scratch(spark: SparkSession):
    """Deletes the tables written inside the block when it ends, so intermediate tables of a long job do not
    add up; ``keep(table)`` hands a table on to the code around the block."""
    tables: list[str] = []
    token = _open.set((*_open.get(), tables))

    def keep(table: DataFrame) -> DataFrame:
        tables.remove(table.written_to)
        if len(_open.get()) > 1:
            _open.get()[-2].append(table.written_to)
        return table

    try:
        yield keep
    finally:
        _open.reset(token)
        for path in tables:
            delete_folder(spark, path)
