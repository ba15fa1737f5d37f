"""Operator 1, MinHash near-dedup with sequential Bayesian verification.

1. One pass over the texts gives each document its set of distinct word shingles (64-bit hashes), a digest of the set and
   a short signature of 8 bits per minimum; a band is 5 bytes of it. Documents of one digest are one class (two sets have
   the same 128-bit digest of their sorted hashes by chance only with a probability of 2^-64 per pair and less).
2. Classes that share a band are candidates. A band is never expanded into all its pairs. First each member meets the
   band's smallest class; what links is one component, so a band that holds one group of near copies is settled. Then only
   bands with members of different components are left: their members, with their signatures, are dealt out by band (large
   bands in blocks of a bounded size that meet each other) and compared where they lie. Two members are compared in the
   first band that they share. What comes out is the members that have a likely partner, one row each.
3. Candidates are verified in sequence: signatures are compared in batches of minima, and after each batch a pair goes if
   the posterior probability that its similarity reaches the threshold (uniform prior, binomial matches) is below the
   chosen miss probability. Survivors are verified on their full shingle sets: members that have one get their sets, meet
   once more in blocks of bounded bytes, and a block unites what links, so that it gives at most one link per member.
   Pairs that fail never leave their block, and a pair within one component needs no check. Each link given is confirmed
   on the shingles of the two whole texts.
4. Links are united into components, and classes give their component to their rows.

Within a band of one component the work is linear in its members. Members of different components that share a band are
compared in pairs where they lie: a group of texts that are just below the threshold of each other costs the square of
its size within a band in comparisons of signature bytes, but never in rows, shuffle or memory.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; a text with fewer
words than a shingle has its whole word sequence as its one shingle; a row with a null id keeps its row, has a null
component and is kept; rows that repeat an id each have the component of their own text; a component is named by the
smallest id of its rows, so the rows of one id with texts that are not linked may lie in different components of the
same name; no rows give no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import spread
from .common import bounded_batches, id_text, meetings, stage, unstage
from .toxicity import whole_rows
from .graph import connected_components

SHINGLE = 5
#: Bands of rows: at a similarity of 0.75 a pair shares no band with a probability of (1 - 0.75^5)^48 = 2e-6.
BANDS, ROWS = 48, 5
#: Verification looks at so many minima at a time.
STEP = 24
#: A pair is dropped when the probability that it reaches the threshold falls below this.
MISS = 1e-6
#: Members of a band that one task holds at a time.
BLOCK = 2048

#: Hashes of the sets in a block whose members are verified.
BLOCK_HASHES = 4 << 20

_SET = "doc_id long, mark long, n_shingles long, digest binary, signature binary"
_SEED = np.random.Generator(np.random.PCG64(20240607))
_A = _SEED.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SEED.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_C = _SEED.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[bytes]:
    """A-Z in lower case, split at space and the signs 9 to 13."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str) -> set:
    """The distinct shingles of a whole text."""
    w = words_of(text)
    if len(w) < SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SHINGLE))))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _set_hashes(text: str) -> np.ndarray:
    w = words_of(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))
    n = len(w) - SHINGLE + 1
    if n < 1:  # the whole sequence; its length keeps it from equalling a shingle
        s = (h * _C[: len(h)]).sum(keepdims=True) + np.uint64(len(h))
    else:
        s = h[:n] * _C[0]
        for i in range(1, SHINGLE):
            s += h[i : n + i] * _C[i]
    return np.unique(_mixed(s))


def _minima(s: np.ndarray) -> np.ndarray:
    out = np.full(len(_A), np.iinfo(np.uint64).max)
    for a in range(0, len(s), 512):
        out = np.minimum(out, (s[a : a + 512, None] * _A + _B >> np.uint64(20)).min(axis=0))
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        n, digest, signature = [], [], []
        for text in b.column("text").to_pylist():
            s = _set_hashes(text)
            n.append(len(s))
            digest.append(hashlib.md5(s.tobytes(), usedforsecurity=False).digest() if len(s) else None)
            signature.append(_mixed(_minima(s)).astype(np.uint8).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(signature, pa.binary())], ["doc_id", "mark", "n_shingles", "digest", "signature"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [_set_hashes(text).tobytes() for text in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array(sets, pa.binary())], ["rep", "hashes"])


@lru_cache
def least_matches(at_least: float, miss: float) -> tuple[int, ...]:
    """For STEP, 2 STEP, ... compared minima: the fewest matches with which a pair goes on.

    A minimum's 8 bits match with probability p = s + (1 - s) / 256. Under a uniform prior the posterior that p is at least
    t, after k matches of n, is the chance of at most k successes in n + 1 draws with chance t.
    """
    t = at_least + (1 - at_least) / 256
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        below, k = 0.0, 0
        while (below := below + comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)) < miss:
            k += 1
        out.append(k)
    return tuple(out)


def _alive(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which of the pairs (row i of x, row j of y) pass every batch of minima."""
    alive, hits = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k, bound in enumerate(least):
        if not len(alive):
            break
        cut = slice(k * STEP, (k + 1) * STEP)
        hits[alive] += (x[i[alive], cut] == y[j[alive], cut]).sum(axis=1)
        alive = alive[hits[alive] >= bound]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _likely(at_least: float, miss: float):
    least = least_matches(at_least, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = np.arange(b.num_rows)
                alive = pa.array(_alive(_signatures(b.column("sa")), _signatures(b.column("sb")), at, at, least))
                yield pa.RecordBatch.from_arrays([b.column("a").take(alive), b.column("b").take(alive)], ["a", "b"])

    return run


class _Members:
    """Members of a block, and the component that each lies in as far as the block knows."""

    def __init__(self, parts: list[pa.RecordBatch], with_sets: bool):
        t = pa.Table.from_batches(parts)
        self.band, self.at, self.rep, self.comp, self.size = (t[c].to_numpy() for c in ("band", "at", "rep", "comp", "size"))
        self.signature = np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint8).reshape(len(t), -1)
        self.sets = [np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()] if with_sets else None
        self.root, self.seen = self.comp.copy(), False

    @cached_property
    def ranks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's distinct hashes, the rank of each hash of each set, and where the sets begin."""
        distinct, rank = np.unique(np.concatenate(self.sets), return_inverse=True)
        return distinct, rank, np.cumsum([0, *map(len, self.sets)])


def _candidates(one: _Members, two: _Members, percent: int, least: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Likely pairs of different components (row of one, row of two), in the order of one's rows; each in the first band it shares."""
    for a in range(0, len(one.rep), 256):
        some = slice(a, a + 256)
        ok = one.root[some, None] != two.root[None, :]
        if one is two:  # each pair once
            ok &= np.arange(a, a + len(ok))[:, None] < np.arange(len(two.rep))[None, :]
        x, y = one.size[some, None], two.size[None, :]
        ok &= 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        i, j = np.nonzero(ok)
        i += a
        for c in range(0, len(i), 100_000):
            x, y = i[c : c + 100_000], j[c : c + 100_000]
            alive = _alive(one.signature, two.signature, x, y, least)
            x, y = x[alive], y[alive]
            shared = (one.signature[x] == two.signature[y]).reshape(-1, BANDS, ROWS).all(axis=2)
            first = shared.argmax(axis=1) == one.at[x]
            if first.any():
                yield x[first], y[first]


def _likely_members(percent: int, miss: float):
    """The members that have a likely partner; a partition is sorted by group, the group's own members first."""
    least = least_matches(percent / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, probes in meetings(batches, "grp", lambda parts: _Members(parts, False)):
            sides = (home, home) if probes is None else (probes, home)
            marked = [np.zeros(len(x.rep), bool) for x in sides]
            for x, y in _candidates(*sides, percent, least):
                marked[0][x] = marked[1][y] = True
            for side, mark in zip(sides, marked):
                if mark.any():
                    yield pa.RecordBatch.from_arrays([pa.array(c[mark]) for c in (side.band, side.at, side.rep, side.comp)], ["band", "at", "rep", "comp"])

    return run


def _links(percent: int, miss: float):
    """Verifies the likely pairs of a block on their whole sets, unites what links, and gives a link for each union."""
    least = least_matches(percent / 100, miss)

    def verified(one: _Members, i: int, two: _Members, js: np.ndarray) -> np.ndarray:
        distinct, rank, begin = two.ranks
        if one is two:
            own = rank[begin[i] : begin[i + 1]]
        else:
            at = np.minimum(np.searchsorted(distinct, one.sets[i]), len(distinct) - 1)
            own = at[distinct[at] == one.sets[i]]
        mark = np.zeros(len(distinct), bool)
        mark[own] = True
        both = np.array([np.count_nonzero(mark[rank[begin[j] : begin[j + 1]]]) for j in js])
        return js[100 * both >= percent * (one.size[i] + two.size[js] - both)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        united: dict[int, int] = {}

        def root(c: int) -> int:
            while c in united:
                c = united[c]
            return c

        def unite(one: _Members, two: _Members) -> Iterator[tuple[int, int]]:
            for x, y in _candidates(one, two, percent, least):
                cuts = [0, *(np.nonzero(np.diff(x))[0] + 1).tolist(), len(x)]
                for a, b in zip(cuts, cuts[1:]):
                    i, js = int(x[a]), y[a:b]
                    js = js[two.root[js] != one.root[i]]
                    if not len(js):
                        continue
                    js = verified(one, i, two, js)
                    for far, j in {int(two.root[j]): int(j) for j in js}.items():
                        yield one.rep[i], two.rep[j]
                        low, high = sorted((int(one.root[i]), far))
                        united[high] = low
                        for side in (one, two):
                            side.root[side.root == high] = low

        for home, probes in meetings(batches, "grp", lambda parts: _Members(parts, True)):
            if not home.seen:
                united.clear()
                home.seen = True
            if probes is not None:
                probes.root = np.array([root(c) for c in probes.root.tolist()], np.int64)
            found = list(unite(home, home) if probes is None else unite(probes, home))
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both whole texts of each pair; rows come sorted by the first, whose set is kept meanwhile."""
        last, left = None, set()
        for batch in batches:
            a, b, keep = batch.column("a").to_pylist(), batch.column("b"), []
            ta, tb = batch.column("ta"), batch.column("tb")
            for i, key in enumerate(a):
                if key != last:
                    last, left = key, shingle_set(ta[i].as_py())
                right = shingle_set(tb[i].as_py())
                both = len(left & right)
                if 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int64())), b.take(pa.array(keep, pa.int64()))], ["a", "b"])

    return run


def _mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def near_duplicates(docs: DataFrame, percent: int = 75, *, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``; links have 100 * intersection >= percent * union."""
    return _grouped(docs, percent, miss, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, percent: int, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of near_duplicates, ``mark`` of the text, and ``grp``: the component, which unlike its name is unique; null without words."""
    bounded_batches(docs.sparkSession)
    texts = id_text(docs, id_col, text_col).withColumn("mark", _mark(F.col("text")))
    sets = stage(spread(texts).mapInArrow(_sets, _SET), "shingle-sets")
    # A class goes by a number of its own: one id may be the smallest of several classes.
    classes = sets.filter("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "mark")).alias("first"), F.any_value("n_shingles").alias("size"), F.any_value("signature").alias("signature")
    )
    classes = stage(classes.select(F.monotonically_increasing_id().alias("rep"), "digest", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"), "size", "signature"), "shingle-classes")

    keys = classes.select("rep", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * ROWS + 1, F.lit(ROWS))))).alias("at", "band"))
    shared = keys.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).filter("n > 1")
    bands = stage(keys.join(shared, "band").select("band", "at", "rep", "n", "hub"), "bands")
    members = stage(classes.join(bands.select("rep").distinct(), "rep", "left_semi").select("rep", "first_id", "first_mark", "size", "signature"), "band-members")
    first = members.select(F.col("first_id").alias("doc_id"), F.col("first_mark").alias("mark"), "rep")
    wanted = stage(texts.join(first, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("rep", "text"), "shingle-texts")

    def confirmed(likely: DataFrame) -> DataFrame:
        text = lambda name, key: wanted.select(F.col("rep").alias(key), F.col("text").alias(name))
        both = likely.join(text("tb", "b"), "b").join(text("ta", "a"), "a").sortWithinPartitions("a")
        return stage(both.mapInArrow(_confirmed(percent), "a long, b long"), "links")

    # Each member of a band meets the band's smallest class.
    side = lambda end: members.select(F.col("rep").alias(end), F.col("size").alias(f"n{end}"), F.col("signature").alias(f"s{end}"))
    pairs = bands.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    links = confirmed(stage(pairs.mapInArrow(_likely(percent / 100, miss), "a long, b long"), "likely"))
    comp = connected_components(links)

    # Members of different components that have not met, band by band.
    labelled = bands.filter("rep <> hub").join(comp, bands["rep"] == comp["id"], "left").select("band", "at", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    left = labelled.join(mixed.select("band", F.ceil(F.col("n") / BLOCK).alias("blocks")), "band").join(members.select("rep", "size", "signature"), "rep")
    likely = stage(_dealt(left).mapInArrow(_likely_members(percent, miss), "band long, at int, rep long, comp long").distinct(), "likely-members")
    if not likely.isEmpty():
        likely = likely.join(members.select("rep", "size", "signature"), "rep")
        blocks = likely.groupBy("band").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_HASHES)).alias("blocks"))
        hashes = stage(wanted.join(likely.select("rep").distinct(), "rep", "left_semi").mapInArrow(_hashed, "rep long, hashes binary"), "shingle-hashes")
        found = _dealt(likely.join(blocks, "band").join(hashes, "rep"), "hashes").mapInArrow(_links(percent, miss), "a long, b long").distinct()
        links = stage(links.union(confirmed(stage(found, "found"))), "links")
        comp = connected_components(links)
    unstage(bands, members, wanted)

    linked = comp.join(classes.select("rep", "first_id"), comp["id"] == F.col("rep")).select("id", "component", "first_id")
    least = linked.groupBy("component").agg(F.min("first_id").alias("least"))
    comp = linked.select("id", "component").join(least, "component")
    named = classes.select("digest", "rep", "first_id").join(comp, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("component", "rep").alias("grp"), F.coalesce("least", "first_id").alias("least"))
    out = sets.select("doc_id", "mark", "n_shingles", "digest").join(named, "digest", "left")
    comp_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", "mark", "n_shingles", "grp", comp_id.alias("component_id"), F.coalesce(F.col("doc_id") == comp_id, F.lit(True)).alias("kept"))


def _dealt(members: DataFrame, *more: str) -> DataFrame:
    """Members of a band in its ``blocks``, each also sent to the earlier ones as a probe; partitions sorted for ``meetings``."""
    left = members.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    row = ["band", "at", "rep", "comp", "size", "signature", *more]
    home = left.select(F.xxhash64("band", "block").alias("grp"), F.lit(False).alias("probe"), *row)
    probes = left.filter("block > 0").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block") - 1)))
    probes = probes.select(F.xxhash64("band", "to").alias("grp"), F.lit(True).alias("probe"), *row)
    return home.union(probes).repartition("grp").sortWithinPartitions("grp", "probe")


def without_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of one document (the smallest id) of each component, with all columns of ``docs``.

    Of the rows of that id whose texts are equal or lie in the same component one stays; its other texts are not touched.
    """
    found = _grouped(docs, percent).filter("kept and doc_id is not null")
    bare = F.when(F.col("grp").isNull(), F.col("mark")).alias("bare")  # texts without words link with nothing
    kept = found.groupBy("doc_id", "grp", bare).agg(F.min("mark").alias("mark")).select("doc_id", "mark")
    rows = docs.select(whole_rows(docs), F.col("doc_id").cast("long").alias("doc_id"), _mark(F.col("text")).alias("mark"))
    out = rows.filter("doc_id is not null").join(kept, ["doc_id", "mark"], "left_semi")
    if not docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():  # reads ids only; texts are sorted only where ids repeat
        out = out.dropDuplicates(["doc_id", "mark"])
    return out.unionByName(rows.filter("doc_id is null")).select("doc.*")
