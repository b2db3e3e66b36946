"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import threading
import uuid
import zipfile
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    from pyarrow.fs import FileSystem

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods above 8000 bytes; wide projections then run
    # faster as split functions than as one generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Recording a call site for every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(name: str = "hearthline", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    # Small splits, so that a single small file is read by all cores.
    settings = {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.sql.files.maxPartitionBytes": "2m", "spark.sql.files.openCostInBytes": "64k",
    }
    for key, value in {**DEFAULTS, **settings, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a folder in
    the warehouse is taken, and set for the session.  On a cluster, a warehouse on a local
    disk is an error: other machines can't read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines reach; the warehouse is a local folder")
        configured = f"{warehouse}/_between"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


def small_methods(spark: SparkSession) -> None:
    """Let Spark split generated methods that the JVM would only interpret, for wide projections.

    A limit that the session sets itself is kept.
    """
    if spark.conf.get(METHOD_BYTES) == "65535":
        spark.conf.set(METHOD_BYTES, DEFAULTS[METHOD_BYTES])


_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; what is written there goes when this process ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(drop_written)
    _WRITTEN.append(path)
    return path


def drop_written() -> None:
    """Delete the tables and files written for this process's queries."""
    while _WRITTEN:
        try:
            system, place = opened(_WRITTEN.pop())
            (system.delete_file if place.endswith(".zip") else system.delete_dir)(place)
        except (OSError, ValueError):  # never written, or a store that is out of reach from here
            continue


def release(*settled: DataFrame) -> None:
    """Delete tables that ``settle`` has written, once nothing will read them any more."""
    for df in settled:
        path = getattr(df, "_settled_at", None)
        if path in _WRITTEN:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
            _WRITTEN.remove(path)


def opened(path: str) -> tuple[FileSystem, str]:
    """The store that a path lies in, and the path within it, for file access from tasks."""
    from pyarrow import fs

    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


_SHIPPED: list[SparkSession] = []


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, for code that runs in Python there.

    Rows then travel in batches of 4 MB instead of 64: each takes memory several times, on
    both sides.  A limit that the session sets itself is kept.
    """
    if any(known is spark for known in _SHIPPED):
        return
    if spark.conf.get(ARROW_BYTES) in ("67108864b", "64MB"):
        spark.conf.set(ARROW_BYTES, "4m")
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(here)))
    path = scratch_path(spark, "hearthline") + ".zip"
    _WRITTEN[-1] = path
    system, place = opened(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.append(spark)


_FREEING = threading.Lock()
_before: list[str] = []  # the setting before, once for each thread that is within
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query has ended.

    For queries whose result is written: nothing reads their shuffles again, and the
    disk of a chain of queries is then that of its largest one.
    """
    with _FREEING:
        if not _before:
            _before.append(spark.conf.get(SHUFFLE_CLEANUP, "false"))
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        else:
            _before.append(_before[0])
    try:
        yield
    finally:
        with _FREEING:
            held = _before.pop()
            if not _before:
                spark.conf.set(SHUFFLE_CLEANUP, held)


def settle(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Compute once, write below the shared folder, and go on from the written table.

    For results used more than once: the copies would otherwise be planned with
    different columns and computed twice.  A lost executor costs no recomputation.
    ``by`` names a last column of few values, in whose folders the rows are laid, so that
    a filter on it reads no others.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._settled_at = path
    return stored
