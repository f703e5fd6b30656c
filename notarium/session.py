"""Session helpers: shipping the package to executors, the shared working folder, table access."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in every Python worker, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / "notarium_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))  # the driver serves it to the executors
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, below ``spark.checkpoint.dir``.

    Where the session names none a folder of this machine is set in local mode
    (tests), which is right there as driver and executors are one process; on a
    cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = at.get() if at.isDefined() else None
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        own = tempfile.mkdtemp(prefix="notarium-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = "file://" + own
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/notarium-{uuid.uuid4().hex}"


def keep(df: DataFrame, compression: str = "lz4") -> DataFrame:
    """Write a result into the shared folder and read it back: it is computed once and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
