"""A streaming source over a table's commits: ``spark.readStream.format("changelog").load(path)`` (SRC11, STR9).

Its offset is a commit version. Each committed file is a partition that yields Arrow batches, so files that are not in
the log are never seen and a restart reads only new commits.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def _log(path: str) -> list[tuple[int, str]]:
    fs, top = filesystem(path)
    found = fs.get_file_info(pafs.FileSelector(f"{top}/_delta_log", allow_not_found=True))
    return sorted((int(f.base_name[:20]), f.path) for f in found if re.fullmatch(r"\d{20}\.json", f.base_name))


def _actions(path: str, file: str) -> list[dict]:
    fs, _ = filesystem(path)
    with fs.open_input_stream(file) as f:
        return [json.loads(x) for x in f.read().decode().splitlines() if x.strip()]


def _schema(path: str) -> str | None:
    """The last schema of the log: from the commits after its last checkpoint, or else from that."""
    fs, top = filesystem(path)
    held = fs.get_file_info(pafs.FileSelector(f"{top}/_delta_log", allow_not_found=True))
    held = max((f.path for f in held if re.fullmatch(r"\d{20}\.checkpoint\.parquet", f.base_name)), default=None)
    start = int(held.rpartition("/")[2][:20]) if held else -1
    for v, f in reversed(_log(path)):
        if v <= start:
            break
        for a in _actions(path, f):
            if "metaData" in a:
                return a["metaData"]["schemaString"]
    if held is None:
        return None
    meta = pq.read_table(held, columns=["metaData"], filesystem=fs)["metaData"].to_pylist()
    return next(m["schemaString"] for m in meta if m)


class CommittedFile(InputPartition):
    def __init__(self, file: str):
        super().__init__(file)
        self.file = file


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"version": -1}

    def latestOffset(self) -> dict:
        log = _log(self.path)
        return {"version": log[-1][0] if log else -1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [CommittedFile(a["add"]["path"]) for v, f in _log(self.path) if start["version"] < v <= end["version"] for a in _actions(self.path, f) if "add" in a and a["add"].get("dataChange", True)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        assert isinstance(partition, CommittedFile)
        fs, top = filesystem(self.path)
        want = to_arrow_schema(self.schema)
        with pq.ParquetFile(fs.open_input_file(f"{top}/{partition.file}")) as f:
            for b in f.iter_batches(8192):
                have = set(b.schema.names)
                yield pa.RecordBatch.from_arrays([b.column(n).cast(want.field(n).type) if n in have else pa.nulls(b.num_rows, want.field(n).type) for n in want.names], schema=want)


class ChangeLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> StructType:
        found = _schema(self.options["path"])
        if found is None:
            raise FileNotFoundError(f"no table at {self.options['path']}")
        return StructType.fromJson(json.loads(found))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeLogReader(self.options["path"], schema)


def register(spark: SparkSession) -> None:
    """The planner of streaming sources runs Python that doesn't see files added to the session, so this module goes by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeLogSource)
