"""Token ids of the word-level vocabulary (a ``tokenizers`` file), as that library gives them, by looking up whole chunks.

Its steps are NFC, white space to one space, lower case, then a split into runs of letters, single digits and runs of
other signs, each merged alone. No piece spans white space, so a text's ids are those of its chunks between white
space, in order. Chunks repeat, so their ids are kept; the library is asked for new ones only, all of a lot of texts together. A
chunk of letters alone is one piece, so it goes to the library's merging step at once, in the step's alphabet. Texts with
characters for which two Unicode versions might differ (outside ASCII and Latin) go to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa

#: The characters whose NFC form is themselves and whose lower case is the same in every Unicode version.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ňŊ-ž]")
MEMO_ENTRIES = 450_000
#: Characters of the texts whose chunks are looked up together.
LOT_CHARS = 1 << 20


def _byte_alphabet() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: itself where it is printed, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SIGNS = _byte_alphabet()


class WordTokens:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes. Special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.whole.encode_special_tokens = True
        self.whole.no_truncation(), self.whole.no_padding()
        spec["normalizer"] = None
        self.plain = Tokenizer.from_str(json.dumps(spec))
        self.plain.encode_special_tokens = True
        self.merging = self.plain.model.tokenize
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.full_stop, self.comma = (self._bytes(self.plain.encode(x, add_special_tokens=False).ids) for x in ".,")

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks that aren't in the memory; a full stop or comma after a letter or digit is a piece of its own."""
        memo, older, merging = self.memo, self.older, self.merging
        ended, other = [], []
        for chunk in chunks:
            c = chunk
            if (got := older.get(c)) is not None:
                memo[c] = got
                continue
            if c[-1] in ".," and len(c) > 1 and c[-2].isalnum():
                ended.append(c)
                c = c[:-1]
                if c in memo:
                    continue
                if (got := older.get(c)) is not None:
                    memo[c] = got
                    continue
            if c.isalpha():
                signs = c if c.isascii() else c.encode().decode("latin-1").translate(_SIGNS)
                memo[c] = array("I", [t.id for t in merging(signs)]).tobytes()
            else:
                other.append(c)
        for c, e in zip(other, self.plain.encode_batch_fast(other, add_special_tokens=False)):
            memo[c] = self._bytes(e.ids)
        for c in ended:
            memo[c] = memo[c[:-1]] + (self.full_stop if c[-1] == "." else self.comma)

    def _lot(self, texts: list[str]) -> list[bytes]:
        chunks = [text.lower().split() for text in texts]
        every = set().union(*chunks)
        new = every.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_ENTRIES:  # what the newer table doesn't take over is forgotten with the older
            self.older, self.memo, new = self.memo, {}, every
        self._learn(new)
        ids = self.memo.__getitem__
        return [b"".join(map(ids, c)) for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        lot: list[int] = []
        chars = 0
        for i, text in enumerate(texts):
            if _OTHER.search(text):
                out[i] = self._bytes(self.whole.encode(text, add_special_tokens=False).ids)
                continue
            lot.append(i)
            chars += len(text)
            if chars >= LOT_CHARS or i == len(texts) - 1:
                for k, ids in zip(lot, self._lot([texts[k] for k in lot])):
                    out[k] = ids
                lot, chars = [], 0
        for k, ids in zip(lot, self._lot([texts[k] for k in lot]) if lot else ()):
            out[k] = ids
        return out


_CODECS: dict[str, WordTokens] = {}


def codec(path: str) -> WordTokens:
    """One per worker process, so that its memory of chunks outlives a task."""
    if path not in _CODECS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _CODECS[path] = WordTokens(path)
    return _CODECS[path]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
