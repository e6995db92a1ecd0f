"""Token counts with a whole-token shortcut (operator 6).

Offline, on the driver, every vocabulary string that ends a word is merged from
its single characters; those that end as one token are proven whole. Over the
corpus a pre-token among them counts one by a look-up, and only the rest are
merged (by the queue and linked list of ``bpe``).
"""

from __future__ import annotations

import functools
import json
import unicodedata

import regex
from pyspark.sql import DataFrame
from tokenizers.normalizers import NFC

from martlet.llm.bpe import byte_chars, merge_symbols
from martlet.llm.common import Remembered, map_texts

# The pre-token pattern and word-end mark of the vocabulary format.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
WORD_END = "</w>"
# Capitals that Unicode 16 added, which Python's own tables may lack, and their small letters.
NEW_CAPITALS = {0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
#: Combining marks: their order is decided by the library's own tables, which may be older or newer than Python's.
_MARK = regex.compile(r"\p{M}")
_NEW_CAPITAL = regex.compile("[" + "".join(map(chr, NEW_CAPITALS)) + "]")


class WordCounter:
    """Counts tokens as a BPE vocabulary with word ends does."""

    def __init__(self, vocabulary_json: bytes, whole: frozenset[str] | None = None):
        spec = json.loads(vocabulary_json)
        self.vocab = spec["model"]["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pre_tokens = regex.compile(WORD_PATTERN).findall
        self.whole = self.prove_whole() if whole is None else whole
        self.counts = Remembered(lambda pre_token: 1 if pre_token in self.whole else self.merged(pre_token))

    def prove_whole(self) -> frozenset[str]:
        """The pre-tokens that encode alone as one token: a vocabulary string with a
        word end, that is UTF-8, that the pattern leaves whole, and whose
        characters merge to exactly that string."""
        by_char = {c: b for b, c in enumerate(byte_chars())}
        proven = set()
        for token in self.vocab:
            if not token.endswith(WORD_END):
                continue
            try:
                word = bytes(by_char[c] for c in token.removesuffix(WORD_END)).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if self.pre_tokens(word) == [word] and self.merged(word) == 1:
                proven.add(word)
        return frozenset(proven)

    def merged(self, pre_token: str) -> int:
        chars = byte_chars()
        symbols = [chars[b] for b in pre_token.encode()]
        symbols[-1] += WORD_END
        return sum(s in self.vocab for s in merge_symbols(symbols, self.ranks))

    def count(self, text: str) -> int:
        pieces, total = [text], 0
        if self.specials is not None and (found := len(self.specials.findall(text))):
            pieces, total = self.specials.split(text), found
        for piece in pieces:
            if not piece.isascii():
                piece = NFC().normalize_str(piece) if _MARK.search(piece) else unicodedata.normalize("NFC", piece)
                # One character at a time: no special case for a sigma that ends a word.
                piece = piece.replace("Σ", "σ")
                if _NEW_CAPITAL.search(piece):
                    piece = piece.translate(NEW_CAPITALS)
            total += sum(map(self.counts.__getitem__, self.pre_tokens(piece.lower())))
        return total


@functools.lru_cache(maxsize=2)
def counter(vocabulary_json: bytes, whole: frozenset[str] | None) -> WordCounter:
    return WordCounter(vocabulary_json, whole)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text of ``docs(doc_id, text)``.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).
    A null text counts as empty; repeated rows give repeated rows; an empty table
    gives none; other columns are not read; very long texts are counted whole. No shuffle. The vocabulary (a fixed
    file of about 2 MB) and the proven whole tokens (at most one per vocabulary
    entry) are broadcast.
    """
    with open(vocabulary, "rb") as f:
        raw = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((raw, counter(raw, None).whole))

    def run(ids: list, texts: list) -> dict[str, list]:
        counting = counter(*shared.value)
        counts = [counting.count(t or "") for t in texts]
        return {"doc_id": ids, "n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": counts,
                "over_limit": [n > limit for n in counts]}

    return map_texts(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                "n_bytes bigint, n_tokens bigint, over_limit boolean")
