"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import shutil
import site
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCRATCH_SCHEMA = "daymill_scratch"

_local_fallback: str | None = None
_sent_to: set[str] = set()


def build_session(app_name: str = "daymill", **conf: str) -> SparkSession:
    """A session with UTC rendering, ANSI arithmetic and adaptive execution.

    The master, memory and shuffle settings are left to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master without ``spark.checkpoint.dir`` gets a folder of its own.
    """
    global _local_fallback
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="daymill-")
    return _local_fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run, inside the shared folder."""
    return f"{shared_dir(spark)}/daymill/{name}-{uuid.uuid4().hex}"


def importable_on_executors(spark: SparkSession) -> None:
    """Send this library along with the application, unless it is found without that.

    It is found where it is installed, on ``PYTHONPATH``, or in the folder that
    a local application was started in.
    """
    root = Path(__file__).resolve().parents[1]
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages(), os.getcwd()]
    context = spark.sparkContext
    if root in {Path(p).resolve() for p in known if p} or context.applicationId in _sent_to:
        return
    folder = tempfile.mkdtemp(prefix="daymill-")
    archive = shutil.make_archive(f"{folder}/daymill", "zip", root, "daymill")
    context.addPyFile(archive)
    _sent_to.add(context.applicationId)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as files below the shared folder: computed once, with no plan behind it.

    For results that outlive the call that makes them. The files stay.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Write ``df`` once to a managed scratch table and drop it afterwards.

    Work that reads the same result several times reads the table, so an
    expensive scan is not repeated and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    location = f"{shared_dir(spark)}/daymill/{SCRATCH_SCHEMA}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_SCHEMA} LOCATION '{location}'")
    table = f"{SCRATCH_SCHEMA}.{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
