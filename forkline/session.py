"""Spark sessions as the engine wants them."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "forkline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and variants that keep the last of repeated keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ready(spark: SparkSession) -> bool:
    """Whether the session answers a trivial query."""
    return spark.sql("select 1 as one").first()["one"] == 1


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the folder that executors share (spark.checkpoint.dir) and without its lineage.

    Where a session on one machine names no folder, as in tests, a temporary one is set; on a cluster that is an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named as checkpoint folder from then on."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or own_folder(spark))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """A temporary folder of this machine, where all executors are threads of this process."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="forkline-")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each context, so that their workers can import it from any folder."""
    context = spark.sparkContext
    if getattr(context, "_forkline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="forkline-")) / "forkline.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(str(target))
    context._forkline_shipped = True
