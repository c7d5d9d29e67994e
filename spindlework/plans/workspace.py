"""Shared work folder and materialised steps.

A step that several later plans read is written once as parquet into the folder
the cluster names in ``spark.checkpoint.dir``.  Reading it back cuts the lineage,
survives the loss of executors, keeps column pruning and gives Catalyst a true
size for its broadcast choice.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_shipped: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    app = context.applicationId
    if app not in _own_folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _own_folder[app] = tempfile.mkdtemp(prefix="spindlework-")
        context.setCheckpointDir(_own_folder[app])
    return _own_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder nobody has used."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once (zstd) and go on from the written table."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once an application, so that the functions their
    Python workers run can be imported wherever the package is not installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        base = f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}"
        if package.is_dir():  # not when it runs from an archive itself
            archive = shutil.make_archive(base, "zip", package.parent, package.name)
            spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
