"""Session defaults. On a cluster the submitting side's settings win; these fill gaps only."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "seedwork", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; never used on a cluster."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a session on one machine (``local``) may do without; there a temporary folder
    of this process is used. On a cluster a missing folder is an error, since executors would write where nobody else can read.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="seedwork-checkpoint-"))
    return df.checkpoint(eager=True)


def sized(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """The table with a broadcast hint if it has at most ``rows`` rows, counted no further than that; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def ship(spark: SparkSession) -> None:
    """Give Python workers this package where they would not find it by themselves; once a session.

    Nothing is done if it is installed, named in PYTHONPATH or lies in the working folder, as workers then import it like the driver.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *(p for p in sys.path if "-packages" in p)]
    if getattr(spark, "_seedwork_shipped", False) or any(p and os.path.abspath(p) == root for p in known):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="seedwork-code-"), "seedwork.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "seedwork")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)  # Spark itself brings the file to the executors
    spark._seedwork_shipped = True
