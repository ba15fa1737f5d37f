"""Operator 10, token-id output in training order.

Documents become sequences of at most ``seq_len`` ids. The sequences get dense numbers 0..n-1 (those of a partition
follow each other; only one count per partition goes to the driver), and a keyed Feistel permutation of the next power
of four, walked along its cycle until it falls below n, turns each number into a global slot: a shuffle of the whole
corpus that needs no random state and can be inverted. Slots are dealt out by range, and each range is written as shards
of ``shard_rows`` records of one fixed stride, so record s is at byte (s mod shard_rows) * stride of shard s div
shard_rows. Reading in slot order is sequential, and a reader resumes at any slot with one seek. Each attempt writes a
shard under a name of its own; the table ``_shards`` beside them names the files of the attempts that Spark committed, so
what a lost or repeated attempt left is never read. No file is renamed or replaced.

Sequences are staged and travel without their padding, in blocks that are compressed column by column: the sequences of a
batch, and then those of a task that belong to the same few shards. The most frequent ids of a block take one byte. The
writer pads.

Record: doc_id int64, piece int32, length int32, then seq_len unsigned 16-bit ids (zeros beyond the length), all little-endian.

Defined cases: a null or empty text has the end id only; a null id is written as the smallest 64-bit integer and read
back as null; repeated rows are sequences of their own; no rows give no shards; ids of 65,536 and more raise an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import spread
from .common import _later, bounded_batches, id_text, runs, shared_dir, stage, unstage
from .tokens import codec, texts_of
from .warc import _filesystem

HEAD = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("length", "<i4")])
NO_ID = -(2**63)
END = b"\0\0\0\0"
ROUNDS = 6
#: Sequences that a task gathers by shard before it sends them, and shards that a writing task holds at a time.
GATHER_ROWS, HELD_SHARDS = 65_536, 4
#: Tasks that write shards, at most.
MOST_TASKS = 20_000
MANIFEST = "shard long, rows long, file string"


def feistel(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1 at ``x``."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, half = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{i}".encode()).digest()[:8], "little")) for i in range(ROUNDS)]

    def mix(v: np.ndarray, k: np.uint64) -> np.ndarray:
        v = (v ^ k) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (v ^ (v >> np.uint64(31))) & mask

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> half, v & mask
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ mix(left, k), left
            else:
                left, right = right, left ^ mix(right, k)
        return left << half | right

    out = once(np.asarray(x, dtype=np.uint64))
    while (far := out >= n).any():  # the domain has at most 4 n numbers, so the walk is short
        out[far] = once(out[far])
    return out.astype(np.int64)


#: Ids of a block that have a byte of their own; the others have this byte and stand apart.
FREQUENT = 255


def _packed(columns: list[np.ndarray], ids: np.ndarray) -> tuple[bytes, int]:
    """Columns of one length and ids, compressed; and the size of what was."""
    counts = np.bincount(ids, minlength=1)
    listed = np.argsort(-counts, kind="stable")[:FREQUENT]
    listed = listed[counts[listed] > 0]
    rank = np.full(len(counts), FREQUENT, np.uint8)
    rank[listed] = np.arange(len(listed))
    short = rank[ids]
    rare = ids[short == FREQUENT]
    head = np.array([len(columns[0]), len(ids), len(listed), len(rare)], "<u4")
    data = b"".join([head.tobytes(), *(c.tobytes() for c in columns), listed.astype("<u2").tobytes(), short.tobytes(), (rare & 255).astype(np.uint8).tobytes(), (rare >> 8).astype(np.uint8).tobytes()])
    return pa.compress(data, "zstd", asbytes=True), len(data)


def _unpacked(block: bytes, size: int, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    data, at = pa.decompress(block, size, "zstd", asbytes=True), 16
    n, n_ids, n_listed, n_rare = np.frombuffer(data, "<u4", 4).tolist()
    columns = []
    for kind in kinds:
        columns.append(np.frombuffer(data, kind, n, at))
        at += columns[-1].nbytes
    listed = np.zeros(FREQUENT + 1, "<u2")
    listed[:n_listed] = np.frombuffer(data, "<u2", n_listed, at)
    at += 2 * n_listed
    short = np.frombuffer(data, np.uint8, n_ids, at)
    low, high = (np.frombuffer(data, np.uint8, n_rare, at + n_ids + k * n_rare) for k in (0, 1))
    ids = listed[short]
    ids[short == FREQUENT] = low.astype("<u2") | high.astype("<u2") << 8
    return columns, ids


def sequences(docs: DataFrame, vocabulary: str, seq_len: int = 256, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``part, first, rows, size, block``: blocks of a partition's sequences (id, piece, length, ids of 16 bits), numbered within it from ``first`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, first = codec(vocabulary), TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            texts = [np.frombuffer(ids + END, "<u4") for ids in words.encode(texts_of(b))]
            tokens = np.array([len(x) for x in texts])
            ids = np.concatenate(texts)
            if ids.max() > 0xFFFF:
                raise ValueError("an id has more than 16 bits")
            n = -(-tokens // seq_len)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(seq_len, tokens[row] - piece * seq_len)
            doc = b.column("doc_id").fill_null(NO_ID).to_numpy()[row]
            block, size = _packed([doc.astype("<i8"), piece.astype("<i4"), length.astype("<u4")], ids.astype("<u2"))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(row)], pa.int64()), pa.array([size], pa.int64()), pa.array([block], pa.binary())], ["part", "first", "rows", "size", "block"])
            first += len(row)

    bounded_batches(docs.sparkSession)
    return spread(id_text(docs, id_col, text_col)).mapInArrow(run, "part int, first long, rows long, size long, block binary")


def record_type(seq_len: int) -> np.dtype:
    return np.dtype([*HEAD.descr, ("ids", "<u2", (seq_len,))])


def _each(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin .. begin + count - 1 of each range, one after the other."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)


def _placed(start: np.ndarray, n: int, key: int, group_rows: int):
    """Sequences with their slots, gathered by group of shards, so that few and small rows are shuffled."""

    def blocks(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        number, doc, piece, length, ids = (np.concatenate(x) for x in zip(*held))
        slot = feistel(number, n, key)
        order = np.argsort(slot, kind="stable")
        begin = (np.cumsum(length, dtype=np.int64) - length)[order]
        slot, doc, piece, length = slot[order], doc[order], piece[order], length[order]
        ids = ids[_each(begin, length.astype(np.int64))]
        at = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        group = slot // group_rows
        cuts = [0, *(np.nonzero(np.diff(group))[0] + 1).tolist(), len(group)]
        packed = [_packed([(slot[a:b] - group[a] * group_rows).astype("<u4"), doc[a:b], piece[a:b], length[a:b]], ids[at[a] : at[b]]) for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(group[cuts[:-1]]), pa.array(np.diff(cuts)), pa.array([s for _, s in packed], pa.int64()), pa.array([x for x, _ in packed], pa.binary())], ["grp", "rows", "size", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for part, first, size, block in zip(*(b.column(c).to_pylist() for c in ("part", "first", "size", "block"))):
                (doc, piece, length), ids = _unpacked(block, size, ("<i8", "<i4", "<u4"))
                held.append((start[part] + first + np.arange(len(doc)), doc, piece, length, ids))
                rows += len(doc)
                if rows >= GATHER_ROWS:
                    yield blocks(held)
                    held, rows = [], 0
        if held:
            yield blocks(held)

    return run


def _put(block: bytes, size: int, into: np.ndarray) -> int:
    """Puts a block's sequences into their places, padded; says how many."""
    (place, doc, piece, length), ids = _unpacked(block, size, ("<u4", "<i8", "<i4", "<u4"))
    into["doc_id"][place], into["piece"][place], into["length"][place] = doc, piece, length
    padded = np.zeros((len(place), into["ids"].shape[1]), "<u2")
    padded[np.arange(padded.shape[1])[None, :] < length[:, None]] = ids
    into["ids"][place] = padded
    return len(place)


def _writer(path: str, n_all: int, seq_len: int, shard_rows: int):
    kind, group_rows = record_type(seq_len), HELD_SHARDS * shard_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition holds whole groups of shards, block after block; each record's place is its slot."""
        fs, top = _filesystem(path)
        fs.create_dir(top, recursive=True)
        group, records, rows = None, None, 0

        def close() -> pa.RecordBatch:
            begin = group * group_rows
            wanted = min(group_rows, n_all - begin)  # slots are dense, so only the last shard is shorter
            if rows != wanted:
                raise ValueError(f"{rows} of {wanted} sequences from slot {begin} on")
            done = []
            for a in range(0, wanted, shard_rows):
                shard = (begin + a) // shard_rows
                file = f"shard-{shard:010d}-{uuid.uuid4().hex}.bin"
                part = records[a : min(a + shard_rows, wanted)]
                with fs.open_output_stream(f"{top}/{file}", compression=None) as out:
                    out.write(part.tobytes())
                done.append({"shard": shard, "rows": len(part), "file": file})
            return pa.RecordBatch.from_pylist(done, pa.schema([("shard", pa.int64()), ("rows", pa.int64()), ("file", pa.string())]))

        for key, part in runs(batches, "grp"):
            if key != group:
                if records is not None:
                    yield close()
                group, rows, records = int(key), 0, np.zeros(group_rows, kind)
            for size, block in zip(part.column("size").to_pylist(), part.column("block").to_pylist()):
                rows += _put(block, size, records)
        if records is not None:
            yield close()

    return run


def write_slots(docs: DataFrame, vocabulary: str, path: str | None = None, seq_len: int = 256, shard_rows: int = 32768, key: int = 20240607, **columns: str) -> tuple[str, DataFrame, int]:
    """Writes the shards; gives their folder, ``shard, rows, file`` per shard, and the number of sequences.

    Without a ``path`` the folder is one in the shared folder that goes when the session ends.
    """
    spark = docs.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/slots-{uuid.uuid4().hex}"
        _later(spark, path)
    seqs = stage(sequences(docs, vocabulary, seq_len, **columns), "sequences")
    counts = sorted((r["part"], r["n"]) for r in seqs.groupBy("part").agg(F.sum("rows").alias("n")).collect())  # one row per input partition
    first, n = np.zeros(counts[-1][0] + 1 if counts else 1, np.int64), 0
    for part, rows in counts:
        first[part], n = n, n + rows
    group_rows = HELD_SHARDS * shard_rows
    groups = -(-n // group_rows)
    tasks = max(1, min(groups, MOST_TASKS))
    placed = seqs.mapInArrow(_placed(first, n, key, group_rows), "grp long, rows long, size long, block binary")
    # Ranges of slots: task t writes the groups t * groups / tasks and on.
    ranged = placed.repartitionById(tasks, F.floor(F.col("grp") * tasks / max(groups, 1)).cast("int")).sortWithinPartitions("grp")
    ranged.mapInArrow(_writer(path, n, seq_len, shard_rows), MANIFEST).write.mode("overwrite").parquet(f"{path}/_shards")
    unstage(seqs)
    return path, spark.read.schema(MANIFEST).parquet(f"{path}/_shards"), n


def read_slots(path: str, seq_len: int, first: int, last: int, shard_rows: int) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """``slot, doc_id, piece, ids`` of the slots first..last-1 in order: one seek, then sequential reads."""
    fs, top = _filesystem(path)
    stride = HEAD.itemsize + 2 * seq_len
    wanted = (pc.field("shard") >= first // shard_rows) & (pc.field("shard") <= (last - 1) // shard_rows)
    listed = pads.dataset(f"{top}/_shards", filesystem=fs, format="parquet").to_table(filter=wanted)
    files = dict(zip(listed["shard"].to_pylist(), listed["file"].to_pylist()))
    while first < last:
        shard = first // shard_rows
        stop = min(last, (shard + 1) * shard_rows)
        if shard not in files:
            raise ValueError(f"there is no slot {first}")
        with fs.open_input_file(f"{top}/{files[shard]}") as f:
            f.seek((first - shard * shard_rows) * stride)
            while first < stop:
                data = f.read(min(stop - first, 1024) * stride)
                if not data or len(data) % stride:
                    raise ValueError(f"shard {shard} is cut off")
                for r in np.frombuffer(data, record_type(seq_len)):
                    yield first, None if r["doc_id"] == NO_ID else int(r["doc_id"]), int(r["piece"]), r["ids"][: r["length"]]
                    first += 1


def slot_digests(docs: DataFrame, vocabulary: str, seq_len: int = 256, shard_rows: int = 32768, key: int = 20240607, **columns: str) -> DataFrame:
    """``doc_id, piece, slot, shard, byte_offset, length, ids_crc32`` of each sequence, as read back from the written shards."""
    path, shards, _ = write_slots(docs, vocabulary, None, seq_len, shard_rows, key, **columns)
    kind = record_type(seq_len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _filesystem(path)
        for b in batches:
            for shard, n, file in zip(b.column("shard").to_pylist(), b.column("rows").to_pylist(), b.column("file").to_pylist()):
                with fs.open_input_file(f"{top}/{file}") as f:
                    at = 0
                    while data := f.read(2048 * kind.itemsize):
                        rec = np.frombuffer(data, kind)
                        crc = [zlib.crc32(x[:k].tobytes()) for x, k in zip(rec["ids"].astype("<u4"), rec["length"].tolist())]
                        slot = shard * shard_rows + at + np.arange(len(rec))
                        doc = pa.array(rec["doc_id"], mask=rec["doc_id"] == NO_ID)
                        yield pa.RecordBatch.from_arrays(
                            [doc, pa.array(rec["piece"]), pa.array(slot), pa.array(np.full(len(rec), shard)), pa.array((slot - shard * shard_rows) * kind.itemsize), pa.array(rec["length"].astype(np.int64)), pa.array(crc, pa.int64())],
                            ["doc_id", "piece", "slot", "shard", "byte_offset", "length", "ids_crc32"],
                        )
                        at += len(rec)
                    if at != n:
                        raise ValueError(f"shard {shard} has {at} of {n} records")

    width = max(1, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    return shards.repartitionById(width, F.pmod("shard", F.lit(width)).cast("int")).mapInArrow(run, "doc_id long, piece int, slot long, shard long, byte_offset long, length long, ids_crc32 long")
