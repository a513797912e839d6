"""Session-level services: the shared work folder and tables written into it.

Lineage is cut only by tables written to the folder that the cluster names in
``spark.checkpoint.dir``, which every executor shares, so a lost executor costs
a re-read and no recomputation.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for local masters without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tabularium-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder, and read back from there."""
    spark = df.sparkSession
    shipped(spark)
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._tabularium_path = path
    spark.__dict__.setdefault("_tabularium_tables", []).append(path)
    return back


def cleared(spark: SparkSession) -> None:
    """Removes all tables that ``written`` made in this session; for the end of a job, when no frame that reads them is used any more."""
    for path in spark.__dict__.pop("_tabularium_tables", []):
        _removed(spark, path)


def _removed(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def discarded(table: DataFrame) -> None:
    """Removes the files of a table made by ``written`` that nothing reads any more."""
    _removed(table.sparkSession, table._tabularium_path)


def shipped(spark: SparkSession) -> None:
    """Gives the executors this package, once per context, so that jobs run from any working folder."""
    context = spark.sparkContext
    if getattr(context, "_tabularium_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tabularium-")) / "tabularium_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tabularium_shipped = True
