"""Session helpers: sensible defaults, code shipping and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cpus: int | str = 8, app: str = "loomcast") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="loomcast-"), "loomcast.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a scratch folder instead.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="loomcast-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
