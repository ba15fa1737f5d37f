"""Operator 3, byte-level BPE encoding and decoding by a lazily determinised transducer.

The merges (ranks) of a byte-level vocabulary are compiled, as texts come, into a transducer over bytes. Its theory: a
token sequence is the encoding of its bytes if and only if each two neighbours are the encoding of their own
concatenation. So each prefix of a piece has exactly one last token, the one that ends there and is compatible with the
last token of the prefix before it. A later token can only begin at a position from which the bytes read so far begin
some vocabulary entry; such positions are live. The chains of last tokens that lead to the live positions share their
beginning, and that much is certain and is emitted. A state is what the future depends on: the last emitted token and
the bytes since. Lookahead is bounded by the longest vocabulary entry. Transitions (state, byte) are determinised when
first met and kept in a bounded table; compatibility of a pair of tokens is decided once, by merging its bytes.

Texts are split by the published pattern. Pieces never span a boundary between white space and what follows it (but for
one leading space), so chunks cut there are encoded alone and their ids are kept, also in a bounded table.

Decoding joins the ids' bytes; the text comes from an incremental UTF-8 state machine that keeps an unfinished
sequence until the next chunk.

Defined cases: a null or empty text has no ids and decodes to no bytes; a null id keeps its row; repeated rows are
encoded as often as they occur; texts of any length are encoded whole; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.files import spread
from .common import bounded_batches, id_text

MEMO_ENTRIES = 400_000
STATES = 400_000
NONE = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file with a base64 token and a rank per line."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class Transducer:
    """Encodes pieces byte by byte; ``feed`` and ``finish`` give ids as soon as they are certain."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {r: t for t, r in ranks.items()}
        # Vocabulary entries as a trie: (node, byte) -> node; a node's token; whether entries go on from it.
        self.go: dict[int, int] = {}
        self.token, self.more = [NONE], [True]
        for data, rank in ranks.items():
            node = 0
            for byte in data:
                to = self.go.get(node << 8 | byte)
                if to is None:
                    to = self.go[node << 8 | byte] = len(self.token)
                    self.token.append(NONE), self.more.append(False)
                    self.more[node] = True
                node = to
            self.token[node] = rank
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: last emitted token (if a token may begin right after it), pending bytes, last token of each pending
        # prefix; then of each live position its place, its trie node, and the end of the first token on the way to it.
        self.states: list[tuple[int, bytes, tuple[int, ...], tuple[int, ...], tuple[int, ...], tuple[int, ...]]] = [(NONE, b"", (), (0,), (0,), (0,))]
        self.index: dict[tuple[int, bytes], int] = {(NONE, b""): 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merged(self, piece: bytes, stop: int = 1) -> list[int]:
        """The ids by the definition: the adjacent pair of lowest rank merges, leftmost first, until ``stop`` parts are left."""
        parts, get, none = [piece[i : i + 1] for i in range(len(piece))], self.ranks.get, 1 << 60
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while len(parts) > stop:
            best = min(scores, default=none)
            if best == none:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token joins; None for a single byte and for one that merging doesn't give."""
        if token not in self.split:
            data = self.tokens[token]
            parts = self.merged(data, 2) if len(data) > 1 else []
            self.split[token] = (parts[0], parts[1]) if len(parts) == 2 and self.merged(data) == [token] else None
        return self.split[token]

    def whole(self, token: int) -> bool:
        """Whether merging a token's own bytes gives it; others occur only as whole pieces."""
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def fits(self, a: int, b: int) -> bool:
        """Whether the two tokens stay two when their bytes are encoded together.

        Merging goes by rising rank, so it is undone from the top: the tokens at the seam are taken apart, the one of
        higher rank first, and at each stage their concatenation must not be a token whose merge would have come
        before the one that was just undone. Right parts of ``a`` lose ties to nothing; left parts of ``b`` win them.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > STATES:
                self.pairs.clear()
            known = self.pairs[key] = self.whole(b) and (a == NONE or self._apart(a, b))
        return known

    def _apart(self, a: int, b: int) -> bool:
        tokens, ranks, until = self.tokens, self.ranks, 1 << 60
        while True:
            joint = ranks.get(tokens[a] + tokens[b])
            if joint is not None and joint < until:
                return False
            ha, hb = self.halves(a), self.halves(b)
            if ha is None and hb is None:
                return True
            if hb is None or ha is not None and a > b:
                until, a = a, ha[1]
            else:  # the merge to the left comes first among equals
                until, b = b + 1, hb[0]

    def _chain(self, last: tuple[int, ...], p: int) -> list[int]:
        """Ends of the tokens that lead to position p, from p back."""
        stops = []
        while p > 0:
            stops.append(p)
            p -= len(self.tokens[last[p - 1]])
        return stops

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, pending, last, live, nodes, roots = self.states[state]
        pending += bytes((byte,))
        n, found, root, go, token, more = len(pending), NONE, 0, self.go, self.token, self.more
        on: list[tuple[int, int, int]] = []
        for p, node, r in zip(live, nodes, roots):
            to = go.get(node << 8 | byte)
            if to is None:
                continue
            # A token that ends here begins at a live position, and exactly one is compatible with what leads there.
            if found == NONE and token[to] != NONE and self.fits(last[p - 1] if p else before, token[to]):
                found, root = token[to], r if p else n
            if more[to]:
                on.append((p, to, r))
        if found == NONE:
            raise ValueError("a byte is no token of this vocabulary")
        on.append((n, 0, root))
        last += (found,)
        emit: tuple[int, ...] = ()
        while on[0][0]:
            cut = on[0][2]
            if any(r != cut for _, _, r in on):
                break
            before = last[cut - 1]  # all ways lead through this token: it is certain
            emit += (before,)
            pending, last = pending[cut:], last[cut:]
            on = [(p - cut, to, self._chain(last, p - cut)[-1] if p > cut else 0) for p, to, _ in on]
        if on[0][0]:
            before = NONE  # nothing begins there any more
        key = (before, pending)
        to = self.index.get(key)
        if to is None:
            if len(self.states) >= STATES:  # the table is full: it starts anew from here
                self._reset()
                state = -1
            to = self.index[key] = len(self.states)
            self.states.append((before, pending, last, *zip(*on)))
        if state >= 0:
            self.moves[state << 8 | byte] = to, emit
        return to, emit

    def feed(self, state: int, data: bytes, out: list[int]) -> int:
        for byte in data:
            move = self.moves.get(state << 8 | byte)
            state, emit = move if move is not None else self._step(state, byte)
            if emit:
                out += emit
        return state

    def finish(self, state: int, out: list[int]) -> None:
        _, pending, last, *_ = self.states[state]
        out += [last[s - 1] for s in reversed(self._chain(last, len(pending)))]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        self.finish(self.feed(0, piece, out), out)
        return out


class Utf8Stream:
    """Decodes chunks of bytes; the state is the unfinished sequence at the end, of three bytes at most."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a valid sequence that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b < 0x80:
                return 0
            if b >= 0xC2:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4 if b < 0xF5 else 0
                if need <= back:
                    return 0
                if back > 1:  # the second byte of some leads is narrower
                    low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                    high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
                    if not low <= data[-back + 1] <= high:
                        return 0
                return back
            if b >= 0xC0:
                return 0
        return 0

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        n = self.unfinished(data)
        self.held = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")

    def finish(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class ByteBpe:
    """Whole texts to ids and back."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.transducer = Transducer(read_ranks(ranks_path))
        self.table = self.transducer.tokens
        self.pattern = regex.compile(pattern)
        self.chunk = regex.compile(r" ?\S+|\s+(?!\S)|\s")
        self.double = regex.compile(r"\s\s|[\x00\s]\Z")
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, list[int]] = {}

    def _chunks(self, text: str) -> list[str]:
        if self.double.search(text) or "\0" in text:
            return self.chunk.findall(text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def _encoded(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(chunk):
            known = self.pieces.get(piece)
            if known is None:
                known = self.transducer.encode(piece.encode("utf-8"))
                if len(piece) <= 64:
                    if len(self.pieces) >= MEMO_ENTRIES:
                        self.pieces.clear()
                    self.pieces[piece] = known
            ids += known
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo, chunks = self.memo, self._chunks(text)
        try:
            return b"".join([memo[c] for c in chunks])
        except KeyError:
            out = []
            for c in chunks:
                got = memo.get(c)
                if got is None:
                    got = self.older.get(c)
                    if got is None:
                        got = self._encoded(c)
                    if len(c) <= 64:
                        if len(memo) >= MEMO_ENTRIES:  # what the newer table doesn't take over is forgotten with the older
                            self.older, memo = memo, {}
                            self.memo = memo
                        memo[c] = got
                out.append(got)
            return b"".join(out)

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_stream(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Text as it becomes certain, from chunks of ids."""
        stream = Utf8Stream()
        for ids in chunks:
            yield stream.feed(self.decode_bytes(ids))
        yield stream.finish()

    def decoded(self, ids: bytes, step: int = 16384) -> tuple[str, list[str]]:
        """The digest of the text's UTF-8 bytes and the text in parts, as the stream decodes ``step`` bytes of ids at a time."""
        sha, parts = hashlib.sha256(), []
        for part in self.decode_stream(ids[a : a + step] for a in range(0, len(ids), step)):
            sha.update(part.encode("utf-8"))
            parts.append(part)
        return sha.hexdigest(), parts


_CODECS: dict[tuple[str, str], ByteBpe] = {}


def codec(ranks_path: str, pattern: str) -> ByteBpe:
    key = (ranks_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = ByteBpe(*key)
    return _CODECS[key]


def encoded_documents(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids binary`` and the decoded ``text`` if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        for b in batches:
            n, ids_sha, text_sha, kept, texts = [], [], [], [], []
            for text in b.column("text").to_pylist():
                ids = bpe.encode(text)
                digest, parts = bpe.decoded(ids)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(digest)
                if keep_ids:
                    kept.append(ids)
                if keep_text:
                    texts.append("".join(parts))
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(kept, pa.binary())), names.append("ids")
            if keep_text:
                cols.append(pa.array(texts, pa.string())), names.append("text")
            yield pa.RecordBatch.from_arrays(cols, names)

    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids + ", text string" * keep_text
    return spread(id_text(docs, id_col, text_col)).mapInArrow(run, schema)
