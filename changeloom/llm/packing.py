"""Operator 5, best-fit packing: hierarchical residual packing.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut. Full pieces are sequences of
their own. In each round every partition packs its items best fit (longest first, into the fullest open sequence that
still has room) and emits those that are nearly full; underfull ones, with the pieces they hold, are the items of the
next round, in fewer partitions, until no two of them fit together; those too full for the smallest one are emitted before. A sequence holds at most ``capacity`` pieces,
so an item is bounded, and what a round passes on shrinks to a few sequences per partition. A partition packs in
windows of a bounded number of items.

Defined cases: a null or empty text has the end id only; a null id is kept as null; repeated rows are packed as
documents of their own; no rows give no rows; a document of n * capacity tokens has exactly n pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import spread
from .common import bounded_batches, id_text, stage
from .tokens import codec, texts_of

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
ITEM = "seq long, used long, done boolean, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
WINDOW_ITEMS = 50_000
#: Underfull sequences that one task of a later round packs at most.
LAST_ITEMS = 20_000
END = b"\0\0\0\0"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of each document: its ids and the end id 0, cut every ``capacity`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        for b in batches:
            rows: list[tuple] = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), words.encode(texts_of(b))):
                ids += END
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[a : a + 4 * capacity]
                    rows.append((doc, k, a // 4, len(cut) // 4, zlib.crc32(cut)))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    bounded_batches(docs.sparkSession)
    return spread(id_text(docs, id_col, text_col)).mapInArrow(run, PIECE)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of the items in each bin. Longest first; each goes to the bin with the least room that is enough.

    Bins of equal room are stacked by that room; a bit mask of the rooms in use finds the least one that fits.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = mask >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                mask ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= sizes[i]
        if room:
            open_bins[room].append(b)
            mask |= 1 << room
    return bins


def _packer(capacity: int, level: int, emit_at: int):
    """Packs the items of a partition; an item has a list of members. ``done`` says that a sequence is nearly full."""
    from pyspark import TaskContext

    def packed(items: list[tuple[int, list[dict]]], base: int) -> list[tuple[int, int, list[dict]]]:
        out = []
        for places in best_fit([n for n, _ in items], capacity):
            members, at = [], 0
            for p in places:
                members += [{**m, "offset": m["offset"] + at} for m in items[p][1]]
                at += items[p][0]
            out.append((base + len(out), at, members))
        return out

    def batch(rows: list[tuple[int, int, list[dict]]], done: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([done] * len(rows)), pa.array([r[2] for r in rows], pa.list_(MEMBER))], ["seq", "used", "done", "members"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        items: list[tuple[int, list[dict]]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, items
            rows = packed(items, base)
            base += len(rows)
            full = [r for r in rows if r[1] >= emit_at]
            items = [(r[1], r[2]) for r in rows if r[1] < emit_at]
            for a in range(0, len(full), 256):
                yield batch(full[a : a + 256], True)

        for b in batches:
            items += zip(b.column("used").to_pylist(), b.column("members").to_pylist())
            if len(items) >= WINDOW_ITEMS:
                before = len(items)
                yield from flush()
                if 2 * len(items) > before:  # nothing more to gain from waiting: pass them on
                    rest = [(base + i, n, m) for i, (n, m) in enumerate(items)]
                    base, items = base + len(rest), []
                    for a in range(0, len(rest), 256):
                        yield batch(rest[a : a + 256], False)
        if items:
            yield from flush()
            rest = [(base + i, n, m) for i, (n, m) in enumerate(items)]
            for a in range(0, len(rest), 256):
                yield batch(rest[a : a + 256], False)

    return run


def pack(parts: DataFrame, capacity: int = 2048, *, nearly_full: float = 0.995, fan_in: int = 8) -> DataFrame:
    """``parts``: the columns of PIECE, staged. Adds ``sequence_id`` and ``offset``."""
    emit_at = int(np.ceil(nearly_full * capacity))
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    out = [parts.filter(F.col("length") == capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (F.lit(127 << 56) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    items = parts.filter(F.col("length") < capacity).select(F.col("length").alias("used"), F.array(member).alias("members"))
    level, n, came = 0, items.rdd.getNumPartitions(), None
    while True:
        level_rows = stage(items.mapInArrow(_packer(capacity, level, emit_at), ITEM), f"pack-{level}")
        low = [r["used"] for r in level_rows.filter("not done").orderBy("used").limit(2).select("used").collect()]
        last = len(low) < 2 or sum(low) > capacity  # no two fit together
        if not last:  # what has no room for the smallest one has room for nothing
            more = ~F.col("done") & (F.col("used") <= capacity - low[0])
            rows, count = level_rows.agg(F.count("*"), F.count_if(more)).first()
            # Only where a task can't hold all that is left: a round without a merge in as few partitions as there may be.
            last = n > 1 and rows == came and n == -(-count // LAST_ITEMS)
        done = level_rows if last else level_rows.filter(~more)
        out.append(done.select("seq", F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", F.col("seq").alias("sequence_id"), "m.offset"))
        if last:
            break
        level, n, came = level + 1, max(-(-count // LAST_ITEMS), -(-n // fan_in)), count
        items = level_rows.filter(more).select("used", "members").repartition(n)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, **columns: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(stage(pieces(docs, vocabulary, capacity, **columns), "pieces"), capacity)
