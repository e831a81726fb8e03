"""Byte-pair encoding by content-defined chunks, and decoding.

A rolling hash of the last bytes cuts each text into chunks, so that passages shared by
documents give the same chunks wherever they stand. The core of a chunk is encoded
once per task and then taken from a cache. A cut may fall inside a token, so each
join is repaired: the text around the cut, from the last safe place before it to the
next one after it, is encoded afresh. A place is safe where the pre-tokeniser starts a
new piece whatever stands around it: at a space or newline after another character, and
where digits or punctuation follow a letter (of ASCII, Han, kana or Hangul). Pieces are
encoded one by one, so the repaired encoding agrees exactly with that of the whole text.
Without such a place the window grows to the next one, up to the whole text; each
character is looked at once, so time grows with the length also then.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard.llm.wordkeys import mix

#: Bytes that the rolling hash sees, and the mean distance of cuts (a power of two).
WINDOW = 24
MEAN_CHUNK = 256
#: Chunks kept in a task's cache, and slots that remember which chunks were met once.
CACHED = 30_000
DOOR_SLOTS = 1 << 20
#: Letters and what may follow them: fixed values, a subset of what the pattern tells apart. No apostrophe.
LETTERS = "A-Za-z\u4e00-\u9fa5\u3041-\u3094\u30a1-\u30fa\uac00-\ud7a3"
MARKS = "0123456789.,!?;:()\u3001\u3002\uff0c\uff0e\uff01\uff1f\uff1b\uff1a\u300c\u300d\u300e\u300f\uff08\uff09\u300a\u300b"
#: Where a piece always starts: a space or newline after no white space, or a mark after a letter.
SAFE = re.compile(rf"(?<=\S)[ \n]|(?<=[{LETTERS}])[{re.escape(MARKS)}]")
_LETTER = re.compile(f"[{LETTERS}]")
SPECIAL = "<|endoftext|>"
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, 256, dtype=np.uint64)


def cut_places(data: bytes) -> np.ndarray:
    """Byte offsets at which the hash of the ``WINDOW`` bytes before is 0 modulo ``MEAN_CHUNK``; never inside a character."""
    buffer = np.frombuffer(data, np.uint8)
    n = len(buffer)
    if n <= WINDOW:
        return np.zeros(0, np.int64)
    values = _GEAR[buffer]
    # sum of value * 3^age over the window, by doubling from runs of 1 to runs of 8 bytes
    rolling, span, factor = values, 1, 3
    while span < 8:
        rolling = rolling[span:] + rolling[:-span] * np.uint64(factor)
        span, factor = 2 * span, factor * factor % 2**64
    rolling = rolling[16:] + rolling[8:-8] * np.uint64(factor) + rolling[:-16] * np.uint64(factor * factor % 2**64)
    at = np.flatnonzero((mix(rolling) & np.uint64(MEAN_CHUNK - 1)) == 0) + WINDOW
    at = at[at < n]
    return at[(buffer[at] & 0xC0) != 0x80]


class ChunkEncoder:
    """Encoder of one task: vocabulary and chunk cache."""

    def __init__(self, vocabulary: str, special_id: int | None = None):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special_id = len(ranks) if special_id is None else special_id
        self.token_bytes = [b""] * (self.special_id + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.token_bytes[self.special_id] = SPECIAL.encode()
        self.cache: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.door = np.zeros(DOOR_SLOTS, np.uint32)

    def chunk(self, core: str) -> list[int] | array:
        """Tokens of a chunk's core; a core met for the second time is kept."""
        ids = self.cache.get(core)
        if ids is not None:
            return ids
        ids = self.older.pop(core, None)
        if ids is None:
            ids = array("i", self.encoding.encode_ordinary(core))
            tag = hash(core)
            slot, mark = tag % DOOR_SLOTS, (tag >> 24) & 0xFFFFFFFF
            if self.door[slot] != mark:
                self.door[slot] = mark
                return ids
        if len(self.cache) >= CACHED // 2:
            self.cache, self.older = {}, self.cache
        self.cache[core] = ids
        return ids

    def ordinary(self, text: str) -> list[int]:
        """Tokens of a text without special tokens, chunk by chunk."""
        data = text.encode()
        places = cut_places(data)
        if len(data) != len(text):  # byte offsets to character offsets
            lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
            places = np.cumsum(lead)[places] - 1
        ids: list[int] = []
        done = 0  # everything before is encoded, and a piece starts here
        last = searched = 0  # the last safe place found, and up to where it was looked for
        for i, place in enumerate(places.tolist()):
            if place < done:
                continue  # inside a window that was already repaired
            end = places[i + 1] if i + 1 < len(places) else len(text)
            last = max(last, self._last_safe(text, max(done, searched), place))
            searched, left = place, max(last, done)
            right = SAFE.search(text, place, end) if left > done or done == 0 else None
            if left <= done or right is None:
                continue  # no safe place on one side: the next join repairs both
            ids += self.chunk(text[done:left])
            ids += self.encoding.encode_ordinary(text[left : right.start()])
            done = right.start()
        ids += self.chunk(text[done:])
        return ids

    @staticmethod
    def _last_safe(text: str, start: int, stop: int) -> int:
        """Last safe place after ``start`` and up to ``stop``, else 0."""
        for at in range(min(stop, len(text) - 1), start, -1):
            sign = text[at]
            if sign == " " or sign == "\n":
                if not text[at - 1].isspace():
                    return at
            elif sign in MARKS and _LETTER.match(text[at - 1]):
                return at
        return 0

    def encode(self, text: str | None) -> list[int]:
        """Tokens of a whole text; the special token's string gives its id."""
        ids: list[int] = []
        for i, part in enumerate((text or "").split(SPECIAL)):
            if i:
                ids.append(self.special_id)
            if part:
                ids += self.ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of tokens, special ones included; bytes that are no UTF-8 give U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode_texts(text: Column, vocabulary: str) -> Column:
    """Token ids of each whole text; a null text counts as empty and gives no tokens."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = ChunkEncoder(vocabulary)  # ends with the task, so a reused worker keeps nothing
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], dtype="object")

    return ids(text)


def decode_ids(tokens: Column, vocabulary: str) -> Column:
    """Text of each list of token ids; null gives null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = ChunkEncoder(vocabulary)  # ends with the task, so a reused worker keeps nothing
        for lists in batches:
            yield pd.Series([None if ids is None else encoder.decode(list(ids)) for ids in lists], dtype="object")

    return texts(tokens)


def encoding_digests(text: Column, vocabulary: str) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    The ids are encoded, decoded again and digested where the text is, so neither ids
    nor decoded texts leave the worker. A null text counts as empty: no tokens, and
    both digests are those of no bytes.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = ChunkEncoder(vocabulary)  # ends with the task, so a reused worker keeps nothing
        names = list(map(str, range(encoder.special_id + 1)))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for texts in batches:
            rows = []
            for t in texts:
                ids = encoder.encode(t)
                rows.append((len(ids), sha(",".join(map(names.__getitem__, ids))), sha(encoder.decode(ids))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
