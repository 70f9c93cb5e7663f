"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")


def local_session(cores: int | str = 8, name: str = "loomcast") -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "1m")  # small files: a task per row group
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one named in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own, since a
    machine-local folder would be lost with its executor on a cluster.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        folder = context.getCheckpointDir()
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used at the boundaries between stages where one result feeds several
    others: the lineage ends there, a lost executor costs no recomputation, and
    readers still prune columns and see real sizes for their join strategy.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, tasks: Sequence[Callable[[], R]]) -> list[R]:
    """Results of independent steps that each start Spark jobs, submitted at once.

    Boosted trees run many short jobs one after the other; next to each other
    they keep the executors busy.
    """
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(len(tasks), 1)) as pool:
        return [f.result() for f in [pool.submit(in_session(t)) for t in tasks]]
