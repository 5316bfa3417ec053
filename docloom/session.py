"""Session set-up for local runs and tests; on a cluster the submitted session is used as it is."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "docloom", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting gets a temporary folder, one for all calls.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="docloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def ensure_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, as ``--py-files`` would."""
    if getattr(spark.sparkContext, "_docloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="docloom-code-")) / "docloom_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    spark.sparkContext._docloom_shipped = True
