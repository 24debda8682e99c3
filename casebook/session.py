"""Session helpers.

On a cluster the session comes from ``spark-submit`` and is used as is; these helpers only fill
settings that are unset (tests and local runs). ``spark.checkpoint.dir`` is read from the session:
a shared folder named by the cluster. Only when it is unset (tests) do we point it at a fresh
scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}

# SQL settings the plans rely on; applied to any session (runtime-settable). Constraint
# propagation enumerates implied predicates over every alias: with the long rule CASE chains it
# grows combinatorially at planning time while gaining nothing (no equality-rich joins here).
PLAN_SETTINGS = {"spark.sql.constraintPropagation.enabled": "false"}


def get_session(master: str | None = None, app: str = "casebook", **conf: str) -> SparkSession:
    """Return the active session, or build a local one with sane small-scale defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_plan_settings(active)
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("CASEBOOK_MASTER", "local[8]"))
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_plan_settings(spark)
    checkpoint_dir(spark)
    return spark


def apply_plan_settings(spark: SparkSession) -> None:
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def compiled_parts(spark: SparkSession) -> Iterator[None]:
    """The JVM never compiles a method of over 8000 bytes of code, which a chain of many rules makes in one piece. Stages
    written in here run operators with longer code one by one, in methods that it does compile. Not for plans that
    rely on a condition keeping an expression from being evaluated (``top_abnormal_tests``)."""
    key, old = "spark.sql.codegen.hugeMethodLimit", None
    try:
        old = spark.conf.get(key, None)
        spark.conf.set(key, "8000")
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def stage(df: DataFrame) -> DataFrame:
    """Materialise a pipeline stage (the reference writes one file per stage): a Parquet table in a
    fresh folder under the shared ``spark.checkpoint.dir``, read back. One computation (an eager
    RDD checkpoint would compute the plan twice), lineage cut, survives executor loss, and later
    reads get column pruning and filter pushdown. The folder must outlive the returned frame, which
    is lazy, so it is left to the owner of the checkpoint folder to clear it."""
    spark = df.sparkSession
    apply_plan_settings(spark)
    path = checkpoint_dir(spark).rstrip("/") + "/stage-" + uuid.uuid4().hex
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir`` if the cluster names one. Only on a
    ``local[*]`` master, where the executors share the driver's disk, a new scratch folder is made;
    elsewhere an unset folder is an error (each executor would write to a disk of its own)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="casebook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
