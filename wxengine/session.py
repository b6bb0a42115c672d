"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings a job of this package wants; a session that already exists keeps its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot never compiles a method of more than 8000 bytes of code; wide projections then
    # run faster in their own, split code than inside a fused stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line behind every column costs more than a small query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state outgrows the heap on a large register; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "wxengine", **conf: str) -> SparkSession:
    """Create (or get) a session with the package defaults, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def dropped_shuffles(*sessions: SparkSession) -> Iterator[None]:
    """Delete each query's shuffle files when it has ended, for the queries of this block.

    Otherwise they stay until the driver collects garbage, so that a job of many queries fills
    the disks of its executors with what none of them reads again.
    """
    before = [(session, session.conf.get(DROP_SHUFFLES, None)) for session in sessions]
    for session in sessions:
        session.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        for session, value in reversed(before):
            if value is None:
                session.conf.unset(DROP_SHUFFLES)
            else:
                session.conf.set(DROP_SHUFFLES, value)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder path that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only where that is
    unset and everything runs in one process (tests) a local temporary folder, removed at
    its end, takes its place; on a cluster that would be an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on {master!r}")
        root = _local_root()
    return f"{root.rstrip('/')}/wxengine/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    folder = tempfile.mkdtemp(prefix="wxengine-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
