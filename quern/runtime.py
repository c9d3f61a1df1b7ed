"""Session helpers shared by every operator: table scans, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that the driver hands to every executor at once; what may be larger is split into parts of that size or refused.
BROADCAST_BYTES = 32 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, so that Python workers can import it anywhere."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quern-package-"), "quern.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one Parquet table of a data directory."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one only where none is configured."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="quern-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of df through a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def broadcast_bytes(spark: SparkSession, payload: bytes, limit: int = BROADCAST_BYTES):
    """Broadcast a payload whose size is checked against limit."""
    if len(payload) > limit:
        raise ValueError(f"{len(payload)} bytes exceed the broadcast bound of {limit}")
    return spark.sparkContext.broadcast(payload)


def blank(c: Column) -> Column:
    """Null or nothing but white space (no-break and ideographic spaces included)."""
    return c.isNull() | (F.length(F.regexp_replace(c, r"[\s\p{Z}]", "")) == 0)
