"""Helpers that the operators of this subpackage share: staged tables, bounded Arrow batches, streamed keyed partitions."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of a batch that goes to a Python worker: vectors are bounded by the first, texts by the second.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20
#: Rows that the Parquet reader holds decoded, and bytes of a row group that the writer holds: a task has both on the heap besides what Spark manages.
READ_ROWS, GROUP_BYTES = 128, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, Parquet batches and row groups, the same for all operators; smaller settings stay."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if not 0 < spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    for name, most in (("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS), ("parquet.block.size", GROUP_BYTES)):
        if not 0 < int(spark.conf.get(name, None) or 0) <= most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; where that is unset, a new one, in local mode only (tests)."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="changeloom-")
        spark.sparkContext.setCheckpointDir(top)
    return top.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage by a written table, so a lost executor costs only the tasks that ran on it. The table goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    _later(spark, path)
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_staged_path", None):
            delete_path(df.sparkSession, path)


def _later(spark: SparkSession, path: str) -> None:
    def clean() -> None:
        try:
            if spark.sparkContext._jsc is not None:
                delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit; the folder is a scratch folder
            pass

    atexit.register(clean)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id as ``doc_id`` and the text as ``text``, null texts as empty; other columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def crc_fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.RecordBatch]]:
    """Cut batches of a partition sorted by ``key`` into slices of one key each; one key may come in several slices."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(k[1:] != k[:-1])[0] + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:]):
            yield k[a], batch.slice(a, b - a)


def meetings(batches: Iterator[pa.RecordBatch], key: str, read: Callable[[list[pa.RecordBatch]], object]) -> Iterator[tuple[object, object | None]]:
    """Blocks of a partition sorted by ``key``, a block's own rows (``probe`` false) first: each block alone, then with each slice of its probes.

    A task holds one block and one batch.
    """
    block, held, home = None, [], None
    for k, part in runs(batches, key):
        if k != block:
            if home is None and held:
                yield read(held), None
            block, held, home = k, [], None
        n = part.num_rows - part.column("probe").true_count
        if n:
            held.append(part.slice(0, n))
        if n < part.num_rows and held:
            if home is None:
                home = read(held)
                yield home, None
            yield home, read([part.slice(n)])
    if home is None and held:
        yield read(held), None


def list_matrix(column: pa.Array, dim: int) -> "object":
    """A list column whose rows all have ``dim`` numbers, as a float64 matrix."""
    import numpy as np

    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), dim)
