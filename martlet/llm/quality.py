"""Quality rules with tokeniser fertility (operator 8).

A public vocabulary reads every whole text; characters per token, the share of
byte-fallback tokens and the entropy of the tokens must lie in the band of the
text's script and writing. Plain counts (words, symbols, repeated lines and windows) come
beside them.
"""

from __future__ import annotations

import functools
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from martlet.llm.common import Remembered, map_texts

#: A repeated window is this many words.
WINDOW = 5
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


@dataclass(frozen=True)
class Band:
    """What a writing's text may measure: each pair is the least and the most."""
    chars_per_token: tuple[float, float]
    byte_share: tuple[float, float]
    entropy: tuple[float, float]  # bits a token, as a share of what EVEN_TOKENS equally frequent ones have
    bits_per_char: tuple[float, float] = (0.0, math.inf)  # both together: the entropy in bits over characters per token


#: Bands by script, which hold for the shortest texts: their figures vary most.
BANDS = {
    "latin": Band((1.2, 8.0), (0.0, 0.10), (0.70, 1.6)),
    "cyrillic": Band((1.0, 8.0), (0.0, 0.20), (0.65, 1.6)),
    "han": Band((0.3, 3.0), (0.0, 0.95), (0.55, 1.6)),
    "other": Band((0.2, 8.0), (0.0, 1.0), (0.50, 1.6)),
}
#: Bands by writing for texts of EVEN_TOKENS tokens and more; edges of shorter ones lie between these and those of the
#: script. Latin is fitted on the documents at hand, the others on prose of their languages (tests/llm/test_filters.py).
#: Writings that the vocabulary spells in letters or bytes differ from noise in their byte share; "other" is any that
#: has no band, perhaps in bytes alone, and "unknown" is code points without a script, which no language is written in.
WRITINGS = {
    "latin": Band((1.7, 8.0), (0.0, 0.10), (0.72, 1.6), (0.0, 4.3)),
    "latin_marked": Band((1.0, 8.0), (0.0, 0.30), (0.60, 1.6)),
    "cyrillic": Band((1.4, 8.0), (0.0, 0.20), (0.65, 1.6)),
    "han": Band((0.45, 3.0), (0.0, 0.85), (0.55, 1.6)),
    "kana": Band((0.70, 3.0), (0.0, 0.40), (0.50, 1.6)),
    "hangul": Band((0.50, 3.0), (0.0, 0.75), (0.50, 1.6)),
    "arabic": Band((0.75, 3.0), (0.0, 0.35), (0.45, 1.6)),
    "devanagari": Band((0.70, 3.0), (0.0, 0.40), (0.45, 1.6)),
    "greek": Band((0.75, 3.0), (0.0, 0.40), (0.45, 1.6)),
    "hebrew": Band((0.75, 3.0), (0.0, 0.35), (0.45, 1.6)),
    "other": Band((0.2, 8.0), (0.0, 1.0), (0.45, 1.6)),
    "unknown": Band((math.inf, math.inf), (0.0, 0.0), (0.0, 0.0)),
}
#: Entropy is measured against texts with this many equally frequent tokens, or as many as they hold.
EVEN_TOKENS = 256
_NOT_LATIN = regex.compile(r"[^\x00-\u024F\u1E00-\u1EFF\u2000-\u206F]")
_SCRIPTS = {name: regex.compile(rf"\p{{Script={name}}}+") for name in ("Latin", "Cyrillic", "Han")}


def script_of(text: str) -> str:
    """The script of most of the text's letters."""
    if not _NOT_LATIN.search(text):
        return "latin"
    n = {name.lower(): sum(map(len, pattern.findall(text))) for name, pattern in _SCRIPTS.items()}
    letters = sum(map(str.isalpha, text))
    best = max(n, key=n.get)
    return best if 2 * n[best] >= letters else "other"


_FINER = {name: regex.compile(rf"[{scripts}]+") for name, scripts in (
    ("kana", r"\p{Hiragana}\p{Katakana}\u30FC"), ("hangul", r"\p{Hangul}"), ("arabic", r"\p{Arabic}"),
    ("devanagari", r"\p{Devanagari}"), ("greek", r"\p{Greek}"), ("hebrew", r"\p{Hebrew}"))}
_UNKNOWN = regex.compile(r"[\p{Co}\p{Cn}]+")
_MARKED = re.compile("[\u0300-\u036F\u1E00-\u1EFF]")


def writing_of(text: str, script: str) -> str:
    """The writing, a finer script, by which a text of ``script`` is judged."""
    if text.isascii():
        return script
    if script == "latin" and not _NOT_LATIN.search(text):
        return "latin_marked" if 20 * len(_MARKED.findall(text)) >= len(text) else "latin"
    letters = sum(map(str.isalpha, text))
    if sum(map(len, _UNKNOWN.findall(text))) > letters:
        return "unknown"
    if script == "latin":
        return "latin_marked" if 20 * len(_MARKED.findall(text)) >= len(text) else "latin"
    if script != "other":
        return script
    n = {name: sum(map(len, pattern.findall(text))) for name, pattern in _FINER.items()}
    if n["kana"]:
        n["kana"] += sum(map(len, _SCRIPTS["Han"].findall(text)))  # Japanese
    best = max(n, key=n.get)
    return best if 2 * n[best] >= letters else "other"


class Fertility:
    """Measures texts with a sentencepiece vocabulary that falls back to bytes.

    Its pieces hold spaces only at their start, so a text is encoded chunk by
    chunk (spaces and what follows), and each distinct chunk once per worker.
    """

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.model.IsByte(i) for i in range(self.model.GetPieceSize())])
        self.pieces = Remembered(self._chunk_ids)
        self.chunks = re.compile(" +[^ ]*").findall

    def _chunk_ids(self, chunk: str) -> bytes:
        # The library puts a space before what it encodes (unless that is nothing), in the place of the one taken off.
        ids = self.model.encode(chunk[1:], num_threads=1) if chunk != " " else [self.model.PieceToId("\u2581")]
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.chunks(" " + text))), "<u4") if text else np.zeros(0, "<u4")

    def measure(self, text: str) -> tuple[float, float, float]:
        """Characters per token, byte share, relative entropy. Under two tokens there is nothing to compare."""
        return self.measured(text)[1:]

    def measured(self, text: str) -> tuple[int, float, float, float]:
        """The number of tokens, and what ``measure`` gives."""
        ids = self.ids(text)
        n = len(ids)
        if n < 2:
            return n, float(len(text)), 0.0, 1.0
        counts = np.bincount(ids)
        shares = counts[counts > 0] / n
        bits = float(-(shares * np.log2(shares)).sum())
        return n, len(text) / n, float(counts[self.is_byte[:len(counts)]].sum() / n), bits / math.log2(min(n, EVEN_TOKENS))


@functools.lru_cache(maxsize=1)
def fertility(model: bytes) -> Fertility:
    return Fertility(model)


def _words(text: str) -> list[bytes]:
    return text.encode().split()  # bytes split at \x20 and \x09-\x0D only


def base_counts(text: str) -> dict[str, int | bool]:
    words = _words(text)
    n = len(words)
    number: dict[bytes, int] = {}
    repeated = 0
    if n > WINDOW:
        # Windows as numbers: equal windows have equal tuples of word numbers.
        w = [number.setdefault(x, len(number)) for x in words]
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:]))
        if len(set(windows)) < len(windows):
            seen, twice = set(), set()
            for x in windows:
                (twice if x in seen else seen).add(x)
            hit = np.zeros(n + 1, np.int64)
            starts = np.array([i for i, x in enumerate(windows) if x in twice])
            np.add.at(hit, starts, 1)
            np.add.at(hit, starts + WINDOW, -1)
            repeated = int((np.cumsum(hit)[:n] > 0).sum())
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line in lines:
            dup += bool(line.encode().split())
        lines.add(line)
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    return {"n_words": n, "word_chars": chars, "n_symbols": len(text) - len(text.translate(_SYMBOLS)),
            "n_dup_lines": dup, "n_repeat_words": repeated, "base_failed": n < 10 or 100 * repeated > 20 * n}


def _edges(short: tuple[float, float], whole: tuple[float, float], part: float) -> tuple[float, float]:
    """The edges of a text that has ``part`` of the tokens for which ``whole`` holds."""
    return whole if part >= 1 else tuple(a if a == b else a + (b - a) * part for a, b in zip(short, whole))


def verdict(text: str, gauge: Fertility, bands: dict[str, Band] = BANDS, writings: dict[str, Band] = WRITINGS) -> tuple[bool, dict]:
    """Whether every measure lies in the band of the text's script and writing, and the measures."""
    n, chars, byte_share, entropy = gauge.measured(text)
    script = script_of(text)
    short, whole = bands[script], writings[writing_of(text, script)]
    part = min(1.0, n / EVEN_TOKENS)
    bits = entropy * math.log2(EVEN_TOKENS) / chars if part >= 1 else 0.0
    ok = all(lo <= x <= hi for x, (lo, hi) in ((chars, _edges(short.chars_per_token, whole.chars_per_token, part)),
                                               (byte_share, _edges(short.byte_share, whole.byte_share, part)),
                                               (entropy, _edges(short.entropy, whole.entropy, part)),
                                               (bits, whole.bits_per_char)))
    return ok, {"script": script, "chars_per_token": chars, "byte_share": byte_share, "token_entropy": entropy}


SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, script string, chars_per_token double, byte_share double, token_entropy double")


def _judge(texts: list, model: bytes, bands: dict[str, Band], writings: dict[str, Band]) -> dict[str, list]:
    gauge, out = fertility(model), {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for text in texts:
        found = base_counts(text or "")
        ok, measures = verdict(text or "", gauge, bands, writings)
        for k, v in (found | measures | {"kept": ok and not found["base_failed"]}).items():
            out[k].append(v)
    return out


def quality(docs: DataFrame, vocabulary: str, bands: dict[str, Band] = BANDS, writings: dict[str, Band] = WRITINGS) -> DataFrame:
    """Counts and verdict for every whole text of ``docs(doc_id, text)``.

    A null text has no words and fails; so does an empty one. Repeated rows give
    repeated rows; an empty table gives none; other columns are not read. No
    shuffle; the vocabulary (a fixed file of about 0.5 MB) is broadcast.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    return map_texts(docs, lambda ids, texts: {"doc_id": ids} | _judge(texts, shared.value, bands, writings),
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def keep_good(docs: DataFrame, vocabulary: str, bands: dict[str, Band] = BANDS, writings: dict[str, Band] = WRITINGS) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns, in one pass."""
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    at = docs.columns.index("text")

    def batches(it):
        for batch in it:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield part.filter(pa.array(_judge(part.column(at).to_pylist(), shared.value, bands, writings)["kept"], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
