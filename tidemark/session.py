"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and the bench. On a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def one_row(spark: SparkSession, schema: str, values: tuple) -> DataFrame:
    """A single row of literals, for control tables. Makes one task and no Python worker."""
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    cells = [F.lit(v).cast(kind).alias(name) for (name, kind), v in zip(fields, values, strict=True)]
    return spark.range(0, 1, 1, 1).select(*cells)
