"""Long texts through a text operator in a JVM of its own, whose heap holds no thousands of them at a time."""

from __future__ import annotations

import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq

RUN = """
import sys
from pyspark.sql import SparkSession
from changeloom.llm.toxicity import without_toxic
top = sys.argv[1]
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{top}/shared").getOrCreate()
docs, labels = spark.read.parquet(f"{top}/documents.parquet"), spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic int")
without_toxic(docs, labels, docs).write.parquet(f"{top}/out")
"""


def test_long_texts_are_read_few_at_a_time(tmp_path):
    n = 4096
    texts = [f"A tree number {i} stood here." + " " * 60_000 for i in range(n)]  # 250 MB, in a single batch of the reader by default
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell", "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert sorted(pq.read_table(tmp_path / "out", columns=["doc_id"])["doc_id"].to_pylist()) == list(range(n))
