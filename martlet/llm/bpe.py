"""Byte-pair encoding and decoding with a public vocabulary file (operator 2).

A pre-token becomes a doubly linked list of symbols. A priority queue holds the
merge rank and place of each adjacent pair; the lowest rank, leftmost first, is
merged, its two new neighbours are queued, and queue entries whose pair has
changed meanwhile are skipped as stale. Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame

from martlet.llm.common import Remembered, map_texts

# The pre-token pattern of byte-level BPE vocabularies.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    a printable Latin-1 byte stands for itself, the others follow from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge ``symbols`` by rank with a priority queue over a doubly linked list."""
    n = len(symbols)
    if n < 2:
        return symbols
    look, pop, push = ranks.get, heapq.heappop, heapq.heappush
    symbols = list(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    # A queue entry is rank and place of the left symbol in one number: lowest rank, then leftmost.
    queue = [rank << 32 | i for i, rank in enumerate(map(look, zip(symbols, symbols[1:]))) if rank is not None]
    heapq.heapify(queue)
    while queue:
        entry = pop(queue)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j < 0 or look((symbols[i], symbols[j])) != entry >> 32:
            continue  # stale: one of the two has been merged with another neighbour
        symbols[i] = merged = symbols[i] + symbols[j]
        after[i] = k = after[j]
        symbols[j], after[j] = "", -1
        if k >= 0:
            before[k] = i
            if (rank := look((merged, symbols[k]))) is not None:
                push(queue, rank << 32 | i)
        if (h := before[i]) >= 0 and (rank := look((symbols[h], merged))) is not None:
            push(queue, rank << 32 | h)
    return [s for s in symbols if s]


class BytePairCodec:
    """Encoder and decoder for a byte-level BPE vocabulary in the tokenizers format."""

    def __init__(self, vocabulary_json: bytes):
        spec = json.loads(vocabulary_json)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        by_char = {c: b for b, c in enumerate(byte_chars())}
        self.strings = [b""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for token, number in self.vocab.items():
            self.strings[number] = bytes(by_char[c] for c in token)
        for token, number in self.added.items():
            self.strings[number] = token.encode()
        self.id_bytes = {s: n.to_bytes(4, "little") for s, n in self.vocab.items()}
        self.pre_tokens = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.by_pre_token = Remembered(self._encode_pre_token)

    def _encode_pre_token(self, pre_token: str) -> bytes:
        chars = byte_chars()
        symbols = merge_symbols([chars[b] for b in pre_token.encode()], self.ranks)
        return b"".join([self.id_bytes[s] for s in symbols])

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, as little-endian unsigned 32-bit integers."""
        look = self.by_pre_token.__getitem__
        if self.specials is None or not self.specials.search(text):
            return b"".join(map(look, self.pre_tokens(text)))
        out = []
        for piece in self.specials.split(text):
            if piece in self.added:
                out.append(self.added[piece].to_bytes(4, "little"))
            else:
                out.extend(map(look, self.pre_tokens(piece)))
        return b"".join(out)

    def decode(self, ids: bytes | Iterable[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids
        return b"".join(map(self.strings.__getitem__, numbers)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(vocabulary_json: bytes) -> BytePairCodec:
    return BytePairCodec(vocabulary_json)


def encode_decode(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text of ``docs(doc_id, text)``.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids``
    also ids (array of int). A null text counts as empty
    (no tokens, digests of nothing); repeated rows give repeated rows; an empty
    table gives none; other columns are not read. No shuffle: each row is
    encoded where it is read. ``vocabulary`` is a path the driver reads; its
    bytes (a fixed file of about 2 MB) are broadcast.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(ids: list, texts: list) -> dict[str, list]:
        bpe = codec(shared.value)
        coded = [bpe.encode(t or "") for t in texts]
        decoded = [bpe.decode(c) for c in coded]
        out = {"doc_id": ids, "n_tokens": [len(c) // 4 for c in coded],
               "ids_sha256": [hashlib.sha256(c).hexdigest() for c in coded],
               "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for d in decoded]}
        if with_ids:
            out["ids"] = [np.frombuffer(c, "<u4").astype("i4") for c in coded]
        return out

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, run, schema + (", ids array<int>" if with_ids else ""))
