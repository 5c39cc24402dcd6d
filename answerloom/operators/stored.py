"""Intermediate tables that several jobs read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session that runs in one process (tests, one machine) may do without; it
    gets a temporary folder.  Elsewhere executors would write to disks of their own, so a
    missing setting is an error.  The session's checkpoint folder is left alone.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("stored tables need spark.checkpoint.dir, a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="answerloom-")
    return _OWN[context.applicationId]


def written_once(rows: DataFrame) -> DataFrame:
    """Write ``rows`` as Parquet in the shared folder and read them back.

    Cuts the lineage: later jobs scan columns they need instead of recomputing,
    and a lost executor costs a re-read.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Remove the tables this session has stored; returns how many.

    To be called when no DataFrame built on them is needed any more.
    """
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        where = hadoop(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
