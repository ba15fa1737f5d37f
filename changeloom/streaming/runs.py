"""Streaming runs: messages to change tables (bronze) and change tables to keyed state (silver) (STR1-14, SNK8-9).

A micro-batch is an epoch: all its tables are written, then its marker, and only then does Spark commit the offsets, so
flushing comes before confirming. Each write carries the batch id in the log; a batch that is run again writes nothing
that is there already. Pulling replaces queues, so nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.feed import handover_guard
from ..operators.merge import plan_merge, visible
from ..sources.catalog import Table
from ..sources.txlog import ChangeTable
from ..sources.wire import decode_messages, rejected, relation_rows, tables_of, typed_rows
from . import changelog


def merge_into(table: ChangeTable, changes: DataFrame, key: str = "id", mode: str = "snapshot_aware", tombstones: bool = True, app_id: str | None = None, batch_id: int | None = None) -> int:
    """Merges a batch; only files whose range of keys meets the batch's are opened, and only those that hold one are rewritten."""
    now = table.snapshot()
    if app_id is not None and now.txns.get(app_id, -1) >= batch_id:
        return now.version
    touched = table.files_with(changes, key)
    target = table._frame(now.schema, [now.files[p] for p in touched])
    return table.replace(plan_merge(target, changes, key, mode, tombstones), now, touched, app_id, batch_id, ranges_of=(key,))


def run_silver(spark: SparkSession, bronze: str, silver: str, checkpoint: str, key: str = "id", mode: str = "snapshot_aware", app_id: str = "silver", tombstones: bool = True, once: bool = True, every: str = "5 seconds") -> StreamingQuery:
    """STR1, STR14: bronze commits as a stream, merged batch by batch."""
    changelog.register(spark)
    state = ChangeTable(spark, silver)
    stream = spark.readStream.format("changelog").load(bronze)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not state.exists():
            from ..operators.merge import empty_state

            state.create(empty_state(batch, tombstones).schema)
        batch.persist()  # the merge reads it twice: for the files that it touches, and for its rows
        try:
            merge_into(state, batch, key, mode, tombstones, app_id, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def silver_view(spark: SparkSession, silver: str) -> DataFrame:
    return visible(ChangeTable(spark, silver).read())


def land(decoded: DataFrame, out: str, catalog: dict[str, Table], layouts: list[tuple[int, Table]], watermark: int, only: frozenset[str], app_id: str, batch_id: int, received_us: int | None = None) -> list[tuple[int, Table]]:
    """One epoch: every table's rows, the rejected messages, then the marker."""
    spark = decoded.sparkSession
    found = layouts + [x for x in tables_of(relation_rows(decoded), catalog) if x not in layouts]
    if only:
        found = [x for x in found if x[1].name in only]
    names = dict.fromkeys((t.schema, t.name) for _, t in found)
    for schema, name in names:
        own = [x for x in found if (x[1].schema, x[1].name) == (schema, name)]
        rows = handover_guard(typed_rows(decoded, own, received_us=received_us), watermark)
        ChangeTable(spark, f"{out}/{name}").append(rows, app_id, batch_id)
    bad = rejected(decoded)
    ChangeTable(spark, f"{out}/_corrupt").append(bad, app_id, batch_id)
    marker = decoded.agg(F.max("lsn").alias("lsn")).select(F.lit(app_id).alias("app"), F.lit(batch_id).cast("long").alias("epoch"), "lsn")
    ChangeTable(spark, f"{out}/_epochs").append(marker, app_id, batch_id)
    return found


def confirmed(spark: SparkSession, out: str) -> DataFrame:
    """SRC2, SNK12: ``lsn, message``: the highest position of a finished epoch (null: none yet), and the feedback message that confirms it.

    It is where a new slot consumer resumes: an epoch's marker is written after all its tables.
    """
    marks = ChangeTable(spark, f"{out}/_epochs")
    rows = marks.read().agg(F.max("lsn").alias("lsn")) if marks.exists() else spark.range(1).select(F.lit(None).cast("long").alias("lsn"))
    position = F.unhex(F.lpad(F.hex("lsn"), 16, "0"))
    return rows.select("lsn", F.concat(F.encode(F.lit("r"), "iso-8859-1"), position, position, position, F.unhex(F.lit("00" * 9))).alias("message"))


def spool(messages: DataFrame, path: str, max_rows: int = 50_000) -> None:
    """STR3, STR5: message files of at most ``max_rows`` rows, so that admission by files bounds the rows of an epoch."""
    messages.select("lsn", "payload").write.mode("append").option("maxRecordsPerFile", max_rows).parquet(path)


def drain(query: StreamingQuery) -> None:
    """STR13: what has arrived is landed, then the run stops; a failure of the run is raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if (e := query.exception()) is not None:
        raise e


def land_snapshot(table: ChangeTable, rows: DataFrame, app_id: str = "snapshot") -> bool:
    """STR10, STR12: a table's snapshot as one commit; a table that has commits is left alone. Says whether it wrote."""
    if table.exists():
        return False
    table.append(rows, app_id, 0, "SNAPSHOT")
    return True


def run_bronze(spark: SparkSession, messages: str, out: str, checkpoint: str, catalog: dict[str, Table] | None = None, watermark: int = 0, only: frozenset[str] = frozenset(), app_id: str = "bronze", max_files: int = 100, once: bool = True, every: str = "5 seconds", received_us: int | None = None, from_lsn: int | None = None) -> StreamingQuery:
    """STR3-6: message files (``lsn long, payload binary``) as a stream; admission by files, a time trigger unless ``once``.

    ``from_lsn`` is the start position (SRC2): messages below it are not landed, but for layouts, which later ones need.
    Layouts seen in earlier batches are kept with the table, so a restarted run knows the relations of old messages.
    """
    stream = spark.readStream.schema("lsn long, payload binary").option("maxFilesPerTrigger", max_files).parquet(messages)
    layouts_table = ChangeTable(spark, f"{out}/_layouts")

    def epoch(batch: DataFrame, batch_id: int) -> None:
        known = []
        if layouts_table.exists():
            known = tables_of(layouts_table.read(), catalog)
        decoded = decode_messages(batch)
        if from_lsn is not None:
            decoded = decoded.filter((F.col("lsn") >= from_lsn) | (F.col("kind") == "R"))
        decoded = decoded.persist()
        try:
            layouts_table.append(relation_rows(decoded), app_id, batch_id)
            land(decoded, out, catalog or {}, known, watermark, only, app_id, batch_id, received_us)
        finally:
            decoded.unpersist()

    writer = stream.writeStream.foreachBatch(epoch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
