"""Operator 7, embedding near-dedup: an exact metric range join.

Vectors are scaled to length one; a cosine of at least t is then a Euclidean distance of at most r = sqrt(2 - 2t). Equal
vectors are first drawn together, so a vector that occurs a million times is joined once. Pivots (distinct vectors of
least hash) cut the space into cells: a vector's home is the cell of its nearest pivot. By the triangle inequality a
vector y can have a partner whose home is cell j only if

    d(y, p_j) <= R_j + r        R_j: the largest distance of a vector of cell j from its pivot
    d(y, p_j)^2 - d(y, p_h)^2 <= 2 r d(p_j, p_h)        the bisector of p_j and y's own pivot p_h is within r

and is copied to the cells j < h that pass both (each pair of cells is joined once). A cell is cut into rings by the
distance from its pivot, each a block of a bounded size; by the triangle inequality again a vector meets only the rings
whose distances from their pivot lie within r of its own, in its home cell too. A ring that holds more vectors than a
block (many at the same distance) is dealt into blocks by hash. Blocks join independently, and no task ever holds more
than one block and one batch. A task adds up each vector's links and unites linked vectors in its block, and returns one
count and at most one link per vector and block, never all pairs.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with nothing and is its
own component; vectors of different lengths never link; a null id keeps its row with null component; repeated rows,
and different vectors of one id, count as vectors of their own, and each has the links and the component of its vector;
a component is named by its smallest id; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, list_matrix, meetings, stage
from .graph import connected_components

#: Slack for rounding in the distances that decide on copies; the links themselves are decided by the cosine.
SLACK = 1e-6
#: Cells that a table of less than so many blocks is cut into; each further one may copy every vector once more.
FEW_PIVOTS = 8
#: Bins of the distance from a pivot, per unit; distances go up to 2.
BINS = 64
#: Tasks that join blocks, at most.
MOST_TASKS = 20_000


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _distances(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cos, 0))


def _homes(pivots: np.ndarray):
    """Home cell, distance from its pivot, and the distance's bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                u, home, far = _unit(list_matrix(b.column("v"), pivots.shape[1])), [], []
                for a in range(0, len(u), 512):
                    cos = u[a : a + 512] @ pivots.T
                    home.append(cos.argmax(axis=1))
                    far.append(_distances(cos[np.arange(len(cos)), home[-1]]))
                home, far = np.concatenate(home).astype(np.int32), np.concatenate(far)
                yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("mult"), b.column("v"), pa.array(home), pa.array(far), pa.array((far * BINS).astype(np.int32))], ["rep", "mult", "v", "home", "far", "bin"])

    return run


class Rings:
    """The blocks of each cell: rings of bins, in the order of their distance from the pivot; a block has up to twice ``block_rows`` vectors."""

    def __init__(self, bins: list, pivots: int, block_rows: int):
        """``bins``: home, bin, n, lo, hi of every bin in use, with the least and the largest distance in it."""
        self.of_bin = np.full((pivots, 2 * BINS + 2), -1, np.int32)
        self.radius = np.full(pivots, -np.inf)
        cell, lo, hi, rows = [], [], [], []
        for home, own in groupby(sorted(bins, key=lambda x: (x["home"], x["bin"])), key=lambda x: x["home"]):
            own = list(own)
            vectors = sum(x["n"] for x in own)
            even = vectors / max(1, round(vectors / block_rows))
            for k, x in enumerate(own):
                if k == 0 or rows[-1] + x["n"] > 1.25 * even:
                    cell.append(home), lo.append(x["lo"]), hi.append(x["hi"]), rows.append(0)
                hi[-1], rows[-1] = x["hi"], rows[-1] + x["n"]
                self.of_bin[home, x["bin"]] = len(cell) - 1
                self.radius[home] = x["hi"]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.blocks = np.maximum(1, np.round(np.array(rows) / block_rows)).astype(np.int64)
        self.first = np.cumsum(self.blocks) - self.blocks
        self.begin = np.searchsorted(np.array(cell), np.arange(pivots + 1))
        self.total = int(self.blocks.sum())


def _each(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each range, and its numbers begin .. begin + count - 1."""
    at = np.repeat(np.arange(len(count)), count)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + begin[at]


def _copies(pivots: np.ndarray, rings: Rings, r: float):
    """A row for each block that a vector goes to: its own (probe false) and those where it meets earlier blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 512):
                yield copied(b.slice(a, 512))

    def copied(b: pa.RecordBatch) -> pa.RecordBatch:
        home, salt, far = (b.column(c).to_numpy() for c in ("home", "salt", "far"))
        at = np.arange(len(home))
        ring = rings.of_bin[home, b.column("bin").to_numpy()]
        own = salt % rings.blocks[ring]
        cos = _unit(list_matrix(b.column("v"), pivots.shape[1])) @ pivots.T
        d = _distances(cos)
        near = d <= rings.radius[None, :] + r + SLACK
        near &= 2 * (cos[at, home][:, None] - cos) <= 2 * r * _distances(pivots[home] @ pivots.T) + SLACK
        near &= np.arange(len(pivots))[None, :] < home[:, None]
        near[at, home] = True
        d[at, home] = far
        y, j = np.nonzero(near)
        pair, other = _each(rings.begin[j], rings.begin[j + 1] - rings.begin[j])
        y, j = y[pair], j[pair]
        meets = (rings.lo[other] - r - SLACK <= d[y, j]) & (d[y, j] <= rings.hi[other] + r + SLACK) & (other < ring[y])
        y, other = y[meets], other[meets]
        pair, probe = _each(rings.first[other], rings.blocks[other])
        before, earlier = _each(rings.first[ring], own)
        row, key = np.concatenate([at, y[pair], before]), np.concatenate([rings.first[ring] + own, probe, earlier])
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(np.arange(len(row)) >= len(at)), *(b.column(c).take(take) for c in ("rep", "mult", "v"))], ["blk", "probe", "rep", "mult", "v"])

    return run


def _forest(linked: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids on a link and the smallest id that each reaches within the matrix."""
    a, b = np.nonzero(linked.any(axis=1))[0], np.nonzero(linked.any(axis=0))[0]
    m, ra, cb = linked[np.ix_(a, b)], rows[a], cols[b]
    big = np.iinfo(np.int64).max
    la, lb = ra.copy(), cb.copy()
    while len(a):
        nb = np.minimum(lb, np.where(m, la[:, None], big).min(axis=0))
        na = np.minimum(la, np.where(m, nb[None, :], big).min(axis=1))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return np.concatenate([ra, cb]), np.concatenate([la, lb])


def _joined(dim: int, at_least: float):
    def rows(ids: np.ndarray, links: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(low, pa.int64())], ["rep", "links", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition is sorted by block, its own vectors first."""
        for home, probes in meetings(batches, "blk", matrix):
            yield from own(*home) if probes is None else meet(home, probes)

    def matrix(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(parts)
        return t["rep"].to_numpy(), t["mult"].to_numpy(), _unit(np.concatenate([list_matrix(p.column("v"), dim) for p in parts]))

    def own(ids: np.ndarray, mult: np.ndarray, u: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(ids), 1024):
            linked = u[a : a + 1024] @ u.T >= at_least
            linked[np.arange(len(linked)), np.arange(a, a + len(linked))] = False
            if linked.any():
                yield rows(ids[a : a + 1024], linked @ mult, ids[a : a + 1024])
                i, low = _forest(linked, ids[a : a + 1024], ids)
                yield rows(i, np.zeros(len(i), np.int64), low)

    def meet(home: tuple, probes: tuple) -> Iterator[pa.RecordBatch]:
        ids, mult, u = home
        p_ids, p_mult, p = probes
        for a in range(0, len(p_ids), 1024):
            linked = p[a : a + 1024] @ u.T >= at_least
            if linked.any():
                some = slice(a, a + 1024)
                yield rows(p_ids[some], linked @ mult, p_ids[some])
                yield rows(ids, linked.T @ p_mult[some], ids)
                i, low = _forest(linked, p_ids[some], ids)
                yield rows(i, np.zeros(len(i), np.int64), low)

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):  # only what says something
            keep = (b.column("links").to_numpy() > 0) | (b.column("rep").to_numpy() != b.column("low").to_numpy())
            if keep.any():
                yield b.filter(pa.array(keep))

    return used


def near_vectors(vectors: DataFrame, at_least: float = 0.9, *, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 4096, max_pivots: int = 4096) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.col(vec_col).cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)) & F.col(id_col).isNotNull(), F.col(vec_col)).alias("v"))
    # A class of equal vectors goes by a number of its own: one id may be the smallest of several classes.
    classes = rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("mult"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("rep"), "first_id", "mult", "v"), "vec-class")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    found = None
    for dim, n in sorted(sizes.items()):  # nearly always one length
        part = _join_one(classes.filter(F.size("v") == dim), dim, n, at_least, block_rows, max_pivots)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stage(found, "vec-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("id", "rep")
    named = comp.join(classes.select("rep", "first_id"), "rep").groupBy("component").agg(F.min("first_id").alias("least"))
    per_class = classes.join(links, "rep", "left").join(comp.join(named, "component").select("rep", "least"), "rep", "left").select(
        F.col("v").alias("cv"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"), F.coalesce("least", "first_id").alias("comp")
    )
    out = rows.join(per_class, rows["v"] == per_class["cv"], "left")
    comp_id = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))


def _join_one(classes: DataFrame, dim: int, n: int, at_least: float, block_rows: int, max_pivots: int) -> DataFrame:
    """``rep, links, low`` among vectors of one length."""
    r = float(np.sqrt(max(0.0, 2 - 2 * at_least)))
    wanted = int(min(max_pivots, max(n // block_rows, min(FEW_PIVOTS, isqrt(n)))))  # a bound on what goes to the driver and into each task
    pivots = _unit(np.array([x["v"] for x in classes.orderBy(F.xxhash64("v", F.lit(7)), "rep").limit(wanted).select("v").collect()], dtype=np.float64))
    kind = dict(classes.dtypes)["v"]
    homes = stage(classes.select("rep", "mult", "v").mapInArrow(_homes(pivots), f"rep long, mult long, v {kind}, home int, far double, bin int"), "vec-home")
    # At most a row for each bin of each pivot.
    rings = Rings(homes.groupBy("home", "bin").agg(F.count("*").alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")).collect(), len(pivots), block_rows)
    salted = homes.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1 << 30)))
    copies = salted.mapInArrow(_copies(pivots, rings, r), f"blk long, probe boolean, rep long, mult long, v {kind}")
    tasks = max(1, min(rings.total, MOST_TASKS))
    dealt = copies.repartitionById(tasks, F.floor(F.col("blk") * tasks / max(rings.total, 1)).cast("int")).sortWithinPartitions("blk", "probe")
    return dealt.mapInArrow(_joined(dim, at_least), "rep long, links long, low long")
