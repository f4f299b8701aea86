"""Session helpers: a local session for tests and bench, and durable scratch space."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "flowline", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="flowline-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset in
    a local run is a machine-local folder created and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = spark.conf.get("flowline.local.scratch", None)
    if not root:
        root = tempfile.mkdtemp(prefix="flowline-scratch-")
        spark.conf.set("flowline.local.scratch", root)
    return root


class _Scopes(threading.local):
    """Open scopes of a thread; streams run their batches in threads of their own."""

    def __init__(self) -> None:
        self.folders: list[str] = []


_scopes = _Scopes()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, inside the current scope if there is one."""
    open_scopes = _scopes.folders
    folder = open_scopes[-1] if open_scopes else f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end.

    For jobs that store their result; a DataFrame that reads such a table must
    not leave the scope.
    """
    folder = scratch_path(spark, name)
    _scopes.folders.append(folder)
    try:
        yield
    finally:
        _scopes.folders.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Like a checkpoint this survives lost executors; unlike one the read-back
    side has exact file sizes, so Spark can decide on broadcasts by size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
