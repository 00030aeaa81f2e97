"""Session helpers: the shared working folder and a test/bench session."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir.

    Only a session that runs in one process may do without it; it gets a temporary folder, removed when
    the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _OWN_DIRS:
            own = tempfile.mkdtemp(prefix="ledgerloom-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _OWN_DIRS[context.applicationId] = own
        folder = _OWN_DIRS[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, never reused."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def literal_frame(spark: SparkSession, values: Iterable[dict], /, **columns: pa.DataType) -> DataFrame:
    """A handful of metadata rows as a literal relation, which needs no job of its own."""
    return spark.createDataFrame(pa.Table.from_pylist(list(values), pa.schema(columns)))
