"""Files that Python reaches by URI, on the driver and on executors, scratch folders, and scans of few partitions (SNK5)."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The filesystem (local, hdfs, s3, gs) of a path as Spark shows it, without escapes, and the path in it."""
    return pafs.FileSystem.from_uri(quote(re.sub(r"^file:/(?!/)", "file:///", path), safe="/:@?&=,+~!$'()*;"))


def scratch(spark: SparkSession, name: str) -> str:
    """The name of a new folder that the driver and all executors reach, below spark.checkpoint.dir; it goes when the session ends.

    Where that setting is absent, a local folder will do, but in local mode only (tests).
    """
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="changeloom-")
    path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def clean() -> None:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may be gone at exit; the folder is a scratch folder
            pass

    atexit.register(clean)
    return path


def spread(rows: DataFrame) -> DataFrame:
    """``rows``, dealt out to all cores if a scan would keep less than a quarter of them busy (a table of one row group, say).

    Larger tables, and what comes out of a shuffle, stay as they are: rows are not shuffled for the sake of a few cores.
    """
    plan, cores = rows._jdf.queryExecution().executedPlan(), rows.sparkSession.sparkContext.defaultParallelism
    if plan.nodeName().startswith("AdaptiveSparkPlan") or 4 * plan.execute().getNumPartitions() > cores:
        return rows
    return rows.repartition(cores)
