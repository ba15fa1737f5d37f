"""Operator 6, exact top-k search: exhaustive term-at-a-time accumulation.

Each vector is a sparse row of integer weights over terms (its components). A block of candidates is turned into
postings (term -> rows and weights); each query adds its weight times those of a term's postings into a dense score
array, one term after the other. A partial selection keeps the k best of each block; blocks of a task merge into a
running best, and tasks merge by a ranked window. Candidates are dealt out in groups and copied once for each block of
queries, so no task holds more than one query block and one batch of candidates.

Defined cases: a vector that is null, empty or holds null or non-finite components takes no part; vectors of different
lengths count as zero beyond their end; ties go to the smaller id; rows with the query's own id are never its partners,
a candidate's row that is repeated appears as often as it occurs; a query's id asks once with each of its different
vectors, and its k best are those of all of them together, so a candidate may appear once for each; fewer candidates than k give fewer rows; no rows give none.
A null id takes no part. Scores are 64-bit sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, runs, stage

MOST_TASKS = 20_000
OUT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """``vec_id, w``: floor(scale * x) of each component, for the vectors that take part."""
    x = F.col(vec_col).cast("array<double>")
    ok = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale))).alias("w")
    )


def _sparse(w: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the non-zero components."""
    sizes = np.asarray(pc.list_value_length(w))
    flat = w.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = flat != 0
    return row[keep], term[keep], flat[keep]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        low = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.nonzero(scores >= low)[0]
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class _Queries:
    """A block of queries, and the k best that each has met."""

    def __init__(self, ids: np.ndarray, w: pa.ListArray, k: int):
        self.ids, self.k = ids, k
        row, term, weight = _sparse(w)
        at = np.searchsorted(row, np.arange(len(ids) + 1))
        self.terms = [(term[a:b], weight[a:b]) for a, b in zip(at, at[1:])]
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def meet(self, ids: np.ndarray, w: pa.ListArray) -> None:
        row, term, weight = _sparse(w)
        order = np.argsort(term, kind="stable")
        row, term, weight = row[order], term[order], weight[order]
        n_terms = int(term[-1]) + 1 if len(term) else 0
        at = np.searchsorted(term, np.arange(n_terms + 1))
        dense = [b - a == len(ids) for a, b in zip(at, at[1:])]
        scores = np.empty(len(ids), np.int64)
        for q, (terms, weights) in enumerate(self.terms):
            scores[:] = 0
            for t, x in zip(terms.tolist(), weights.tolist()):
                if t < n_terms:
                    a, b = at[t], at[t + 1]
                    if dense[t]:  # the postings name every row
                        scores += x * weight[a:b]
                    else:
                        scores[row[a:b]] += x * weight[a:b]
            other = ids != self.ids[q]
            own, own_ids = (scores, ids) if other.all() else (scores[other], ids[other])
            top = _best(own, own_ids, self.k)
            s, i = np.concatenate([self.best[q][0], own[top]]), np.concatenate([self.best[q][1], own_ids[top]])
            top = _best(s, i, self.k)
            self.best[q] = (s[top], i[top])

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.best]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, n), pa.int64()), pa.array(np.concatenate([i for _, i in self.best]), pa.int64()), pa.array(np.concatenate([s for s, _ in self.best]), pa.int64())],
            ["query_id", "vec_id", "score"],
        )


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition is sorted by group, queries first."""
        group, block, held = None, None, []
        for key, part in runs(batches, "grp"):
            if key != group:
                if block is not None:
                    yield block.rows()
                group, block, held = key, None, []
            kind = part.column("cand").to_numpy(zero_copy_only=False)
            n = int((~kind).sum())
            if n:
                held.append(part.slice(0, n))
            if n < part.num_rows:
                if block is None:
                    if not held:
                        continue
                    t = pa.Table.from_batches(held).combine_chunks()
                    block = _Queries(t["vec_id"].to_numpy().astype(np.int64), t["w"].combine_chunks() if t["w"].num_chunks != 1 else t["w"].chunk(0), k)
                rest = part.slice(n)
                block.meet(rest.column("vec_id").to_numpy().astype(np.int64), rest.column("w"))
        if block is not None:
            yield block.rows()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, query_block: int = 2048, candidate_group: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k highest integer inner products of each row that ``is_query`` (over ``vec_id``) holds for."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = stage(quantised(vectors, id_col, vec_col, scale), "topk-rows")
    n, n_q = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, groups = max(1, -(-n_q // query_block)), max(1, -(-n // candidate_group))
    deal = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m))
    # A group is one block of queries and one share of the candidates: block * groups + share.
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "w"]).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), deal(1, blocks).alias("b"), "vec_id", "w", F.lit(False).alias("cand"))
    candidates = rows.select(deal(2, groups).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "vec_id", "w", F.lit(True).alias("cand"))
    both = queries.unionByName(candidates).select((F.col("b") * groups + F.col("g")).cast("long").alias("grp"), "cand", "vec_id", "w")
    tasks = min(blocks * groups, MOST_TASKS)  # by number, not by hash: each task has as many groups as any other
    found = both.repartitionById(tasks, F.pmod("grp", F.lit(tasks)).cast("int")).sortWithinPartitions("grp", "cand").mapInArrow(_search(k), OUT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
