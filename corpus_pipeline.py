"""The corpus pipeline: documents pass four stages, each written as Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and keeps or packs all that its predecessor kept. Models are fitted on the labelled
rows of the corpus itself (``sf_dir``), so a stage does not lose its examples to the stages before it.

Defined cases, for every stage: all columns but ``doc_id`` and ``text`` are carried whole, whatever their names, and may be
null (``source`` and ``lang`` are read as a site; null is a site of its own). A null text counts as an empty one. A row
with a null id is judged by its text like any other, is never a near duplicate, and is packed under a null id. Of equal
rows one stays after the near-duplicate stage; rows of one id with texts that are not linked all stay. Ties in a score are
decided by the threshold alone (0.5: good, and toxic). Texts of any length are read whole. An empty corpus gives an empty
result, and one without labels of both kinds keeps what the prior keeps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from changeloom.deploy import ship
from changeloom.llm.common import _later, shared_dir
from changeloom.llm.neardup import without_near_duplicates
from changeloom.llm.packing import packed_documents
from changeloom.llm.quality import good_documents
from changeloom.llm.queries import vocabulary
from changeloom.llm.toxicity import without_toxic


def _corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return good_documents(docs, _corpus(spark, sf_dir, "labels"), _corpus(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return without_toxic(docs, _corpus(spark, sf_dir, "labels"), _corpus(spark, sf_dir, "documents"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return without_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packed_documents(docs, vocabulary("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity),
    ("minhash near-dedup", minhash_near_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Learnt models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _corpus(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{i}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        _later(spark, path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
