"""Benchmark decontamination by suffix arrays of the training text (operator 13).

Every task turns its documents, in shards of a bounded number of words, into a
suffix array over words and looks every suffix of the benchmark items up in it by
binary search. The range of equal prefixes gives all places of a window; narrowing
the range word by word gives the longest verbatim match and where it stands.

Only words that can belong to a match enter a shard's array: a run of words ends
at a word, or between two neighbours, that no item has, and a run shorter than the
shortest window is left out. No match of a window or more is lost by this.

The items travel to the tasks in blocks of a checked size (``block_bytes``). More
benchmark text means more blocks, each of which is looked up in all shards; what
the blocks find for a text is merged by the digest of the text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from martlet.llm.common import discard, materialize

#: Bytes as they stand in words: A-Z in lower case, what is not in a word as a space.
_IN_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text split into words at a time, words of a shard, and words of an item in one piece.
CHUNK, SHARD, PIECE = 1 << 22, 2_000_000, 4096
#: Slots of the table that sorts out most pairs of words that no item has.
_TABLE_BITS = 22


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, in lists that bound the objects alive at a time."""
    text, at = text.translate(_IN_WORDS), 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, at, words, need): the items cut into pieces that share all but one word of
    a window, each with the place of its first word, and the window's length."""
    schema = pa.schema([("item", pa.string()), ("at", pa.int64()), ("words", pa.string()), ("need", pa.int32())])

    def cut(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for item, text in zip(batch.column(0).to_pylist(), texts):
                found = [w.decode() for part in words(text.as_py() or b"") for w in part]
                if found:
                    need = min(window, len(found))
                    places = range(0, len(found) - need + 1, PIECE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(places), pa.string()), pa.array(places, pa.int64()),
                         pa.array([" ".join(found[at:at + PIECE + need - 1]) for at in places]), pa.array([need] * len(places), pa.int32())],
                        schema=schema)

    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text")).mapInArrow(
        cut, "item string, at long, words string, need int").distinct()


@dataclass
class _Block:
    """One block of items: word ids, and per place of a suffix that starts a window the window's length and the item."""
    ids: dict[bytes, int]
    tokens: np.ndarray      # of all pieces, 0 between them
    starts: np.ndarray      # places where a window starts
    need: np.ndarray        # its length
    item: np.ndarray        # its item, by place in ``names``
    place: np.ndarray       # its first word's place in the item
    names: list[str]        # in ascending order
    pairs: np.ndarray       # neighbours, sorted

    @classmethod
    def of(cls, pieces) -> _Block:
        ids: dict[bytes, int] = {}
        names = sorted({p["item"] for p in pieces})
        number = {name: k for k, name in enumerate(names)}
        tokens, starts, need, item, place, at = [], [], [], [], [], 0
        for p in pieces:
            found = [ids.setdefault(w, len(ids) + 1) for w in p["words"].encode().split(b" ")]
            n = len(found) - p["need"] + 1
            tokens += [np.array(found, np.int64), np.zeros(1, np.int64)]
            starts.append(np.arange(at, at + n))
            place.append(p["at"] + np.arange(n))
            need.append(np.full(n, p["need"]))
            item.append(np.full(n, number[p["item"]]))
            at += len(found) + 1
        flat = np.concatenate([*tokens, np.zeros(1, np.int64)])
        both = (flat[:-1] > 0) & (flat[1:] > 0)
        pairs = np.unique(flat[:-1][both] * (len(ids) + 1) + flat[1:][both])
        none = [np.zeros(0, np.int64)]
        return cls(ids, flat, *(np.concatenate(x or none) for x in (starts, need, item, place)), names, pairs)

    def table(self) -> np.ndarray:
        out = np.zeros(1 << _TABLE_BITS, bool)
        out[_slot(self.pairs)] = True
        return out


def _slot(pairs: np.ndarray) -> np.ndarray:
    # A multiplicative hash; the constant is 2**64 over the golden ratio.
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


def _candidate_runs(tokens: np.ndarray, block: _Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the runs of words that may hold a window."""
    if not len(block.need):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = tokens > 0
    linked = np.zeros(len(tokens), bool)  # to the next word, by a pair that an item has
    at = np.flatnonzero(known[:-1] & known[1:])
    pair = tokens[at] * (len(block.ids) + 1) + tokens[at + 1]
    some = table[_slot(pair)]
    at, pair = at[some], pair[some]
    where = np.minimum(np.searchsorted(block.pairs, pair), max(0, len(block.pairs) - 1))
    linked[at[block.pairs[where] == pair] if len(block.pairs) else at[:0]] = True
    first = known.copy()
    first[1:] &= ~linked[:-1]
    last = known & ~linked
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = b - a >= block.need.min()
    return a[long], b[long]


def suffix_array(tokens: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places with ``left > 0`` in the order of the words from there, of which ``left``
    count and ``depth`` are compared, by prefix doubling."""
    at, done = np.flatnonzero(left > 0), 1
    rank = np.where(left > 0, tokens, 0)
    while done < depth:
        after = np.zeros(len(at), np.int64)
        more = left[at] > done
        after[more] = rank[at[more] + done]
        key = rank[at] * (rank.max() + 1) + after
        _, new = np.unique(key, return_inverse=True)
        rank[at] = new + 1
        done *= 2
        if len(new) and new.max() + 1 == len(at):
            break
    return at[np.argsort(rank[at], kind="stable")]


def _bounds(text, sa, query, starts, need) -> tuple[np.ndarray, np.ndarray]:
    """Per query the range of ``sa`` whose suffixes begin with its ``need`` words."""
    widest = int(need.max())

    def first(above: bool) -> np.ndarray:
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(sa), np.int64)
        for _ in range(len(sa).bit_length()):
            mid = (low + high) >> 1
            at = sa[np.minimum(mid, len(sa) - 1)]
            sign = np.zeros(len(starts), np.int64)
            for k in range(widest):
                open_ = (sign == 0) & (k < need)
                if not open_.any():
                    break
                sign[open_] = np.sign(text[at[open_] + k] - query[starts[open_] + k])
            right = (sign < 0) | (above & (sign == 0))
            right &= low < high
            low, high = np.where(right, mid + 1, low), np.where(right, high, np.where(low < high, mid, high))
        return low

    return first(False), first(True)


def _longest(text, sa, query, starts, need, low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The longest match of each query and the range of ``sa`` that has it."""
    depth, low, high = need.copy(), low.copy(), high.copy()
    active = np.arange(len(starts))
    while len(active):
        want = query[starts[active] + depth[active]]
        active, want = active[want > 0], want[want > 0]
        ends = []
        for above in (False, True):
            a, b = low[active].copy(), high[active].copy()
            while (a < b).any():
                mid = (a + b) >> 1
                seen = text[sa[np.minimum(mid, len(sa) - 1)] + depth[active]]
                right = (a < b) & ((seen < want) | (above & (seen == want)))
                a, b = np.where(right, mid + 1, a), np.where(right | (a >= b), b, mid)
            ends.append(a)
        on = ends[0] < ends[1]
        active = active[on]
        low[active], high[active] = ends[0][on], ends[1][on]
        depth[active] += 1
    return depth, low, high


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, and the range that each is of."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which], which


class _Shard:
    """Words of some documents one after another, 0 between them, and what of a block occurs in them."""

    def __init__(self, token_lists: list[np.ndarray], block: _Block, table: np.ndarray):
        gap = np.zeros(1, np.int64)
        self.sizes = np.array([len(t) for t in token_lists])
        self.begin = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.tokens = np.concatenate([x for t in token_lists for x in (t, gap)])
        self.block = block
        a, b = _candidate_runs(self.tokens, block, table)
        # The runs alone, each with a 0 behind it, and room to look past the last.
        self.origin, which = _expand(a, b + 1)
        inside = self.origin < b[which]
        self.text = np.concatenate([np.where(inside, self.tokens[self.origin], 0), np.zeros(2 * PIECE, np.int64)])
        left = np.zeros(len(self.text), np.int64)
        left[:len(which)] = np.where(inside, b[which] - self.origin, 0)
        longest = int(np.diff(np.flatnonzero(block.tokens == 0), prepend=-1).max())
        self.sa = suffix_array(self.text, left, min(int((b - a).max()), longest)) if len(a) else a
        if len(a):
            low, high = _bounds(self.text, self.sa, block.tokens, block.starts, block.need)
            hit = np.flatnonzero(low < high)
            self.hit, self.low, self.high = hit, low[hit], high[hit]
        else:
            self.hit = self.low = self.high = np.zeros(0, np.int64)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, places, side="right") - 1

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, end) of the maximal runs of words inside occurrences of windows."""
        need = self.block.need[self.hit]
        windows = np.unique(np.stack([self.low, self.high, need]), axis=1)  # a window that several items have counts once
        at, which = _expand(windows[0], windows[1])
        at = self.origin[self.sa[at]]
        step = np.zeros(len(self.tokens) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + windows[2][which], -1)
        covered = np.concatenate([[0], (np.cumsum(step) > 0).astype(np.int8), [0]])
        edge = np.diff(covered)
        a, b = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        doc = self.document(a)
        return doc, a - self.begin[doc], b - self.begin[doc]

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) of all items with a window there, in ascending order."""
        n, found = max(1, len(self.block.names)), np.zeros(0, np.int64)
        at = 0
        while at < len(self.hit):  # as many ranges at a time as hold about four million places
            end = max(at + 1, int(np.searchsorted(np.cumsum(self.high[at:] - self.low[at:]), 4_000_000)) + at)
            places, which = _expand(self.low[at:end], self.high[at:end])
            doc = self.document(self.origin[self.sa[places]])
            found = np.union1d(found, doc * n + self.block.item[self.hit[at:end]][which])
            at = end
        return found // n, found % n

    def matches(self) -> tuple[np.ndarray, ...]:
        """(query, document, first word there, words) of each query's longest matches that
        no word before both continues."""
        block = self.block
        starts, need = block.starts[self.hit], block.need[self.hit]
        depth, low, high = _longest(self.text, self.sa, block.tokens, starts, need, self.low, self.high)
        places, which = _expand(low, high)
        at = self.origin[self.sa[places]]
        before = np.where(starts[which] > 0, block.tokens[starts[which] - 1], 0)
        there = np.where(at > 0, self.tokens[at - 1], 0)
        ok = (before == 0) | (before != there)
        at, which = at[ok], which[ok]
        doc = self.document(at)
        return self.hit[which], doc, at - self.begin[doc], depth[which]


def _shards(batches, block: _Block):
    """(ids, digests of the texts, shard) of the documents that fill a shard."""
    table, get = block.table(), block.ids.get
    ids, marks, lists, size = [], [], [], 0
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for k in range(batch.num_rows):
            text = texts[k].as_py() or b""
            parts = [np.fromiter(map(get, part, repeat(0)), np.int64, len(part)) for part in words(text)]
            ids.append(batch.column(0)[k].as_py())
            marks.append(hashlib.sha256(text).hexdigest())
            lists.append(np.concatenate([np.zeros(0, np.int64), *parts]))
            size += len(lists[-1]) + 1
            if size >= SHARD:
                yield ids, marks, _Shard(lists, block, table)
                ids, marks, lists, size = [], [], [], 0
    if ids:
        yield ids, marks, _Shard(lists, block, table)


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[_Block]:
    """The benchmark in blocks, one empty block at least; about ``block_bytes`` of it are on the driver at a time."""
    pieces = materialize(_pieces(benchmark, window), "benchmark-pieces")
    size = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    count = max(1, math.ceil(size / block_bytes))
    for k in range(count):
        found = pieces.where(F.pmod(F.xxhash64("item", "at", "words"), F.lit(count)) == k).collect()
        if found or k == 0:
            yield _Block.of(found)
    discard(pieces)


def _search(docs: DataFrame, block: _Block) -> DataFrame:
    """(doc_id, text_digest, n_words, hits, items) of every document for one block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    id_field = docs.schema["doc_id"].dataType
    kind = to_arrow_type(id_field)

    def run(batches):
        block = sent.value
        for ids, marks, shard in _shards(batches, block):
            count = np.arange(len(ids) + 1)
            doc, a, b = shard.intervals()
            item_doc, item = shard.items()
            hits = pa.ListArray.from_arrays(np.searchsorted(doc, count).astype(np.int32), pa.StructArray.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["from", "to"]))
            names = pa.ListArray.from_arrays(np.searchsorted(item_doc, count).astype(np.int32),
                                             pa.array(block.names, pa.string()).take(pa.array(item)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(marks, pa.string()), pa.array(shard.sizes, pa.int64()), hits, names],
                                             names=["doc_id", "text_digest", "n_words", "hits", "items"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_field.simpleString()}, text_digest string, n_words long, {_HITS}, items array<string>")


_HITS = "hits array<struct<from: long, to: long>>"


def _merged(hits: pa.Array) -> pa.Array:
    """Intervals in order, those that meet as one."""
    out = []
    for row in hits.to_pylist():
        done: list[dict] = []
        for x in sorted(row, key=lambda x: (x["from"], x["to"])):
            if done and done[-1]["to"] >= x["from"]:
                done[-1]["to"] = max(done[-1]["to"], x["to"])
            else:
                done.append(dict(x))
        out.append(done)
    return pa.array(out, hits.type)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """Which words of ``docs(doc_id, text)`` stand inside a window of ``benchmark(item_id, text)``.

    Words are runs of ASCII digits, letters (A-Z in lower case) and characters
    beyond ASCII. A window is ``window`` consecutive words of an item, or a shorter
    item whole. Returns per row of ``docs``: doc_id, n_words, n_hit, n_items (items
    of which a window occurs), items_sha256 (of their ids as strings, sorted,
    comma-joined), contaminated, items, hits (word places, end exclusive) and
    text_digest (SHA-256 of the text).

    A null or empty text, and one of other characters alone, has no words and no
    hits; such an item has no window. Texts and items of any length are searched
    whole. Repeated rows and equal or null doc_ids are rows of their own, and copies
    of a text find the same. Items that share an id, however often given, are one
    item with the windows of each; a null id is the empty string. Where many windows
    or items meet at one place, all count. An empty ``docs`` gives no rows, an empty
    ``benchmark`` no hits. Other columns are not read; doc_id may be of any type.
    """
    first, *others = [_search(docs, block) for block in _blocks(benchmark, window, block_bytes)]
    if others:
        # Copies of a text find the same, so a set holds at most one value for each block.
        more = (reduce(DataFrame.unionByName, others).where(F.size("items") > 0).groupBy("text_digest")
                .agg(F.flatten(F.collect_set("hits")).alias("more_hits"), F.flatten(F.collect_set("items")).alias("more_items")))
        merged = F.arrow_udf(_merged, _HITS.removeprefix("hits "))
        joined = first.join(more, "text_digest", "left")
        both = lambda c: F.when(F.col("more_hits").isNull(), F.col(c)).otherwise(F.concat(c, f"more_{c}"))
        first = joined.select("doc_id", "text_digest", "n_words", merged(both("hits")).alias("hits"), F.array_distinct(both("items")).alias("items"))
    n_hit = F.expr("aggregate(hits, 0L, (n, x) -> n + x.to - x.from)")
    return first.withColumn("items", F.array_sort("items")).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "items", "hits", "text_digest")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no window of ``benchmark``, with all their columns."""
    bad = contamination(docs, benchmark, window, block_bytes).where("contaminated").select(F.col("text_digest").alias("__digest")).distinct()
    return docs.join(bad, F.sha2(F.coalesce(docs["text"].cast("binary"), F.lit(b"")), 256) == F.col("__digest"), "left_anti")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """The longest verbatim matches of the suffixes of the items, and where they stand.

    Returns doc_id, doc_word, item_id, item_word (first words, from 0) and n_words.
    For every suffix of an item that has a match of a window or more in a shard of
    documents there is a row for each place of its longest match there, unless the
    words before both agree, so that a longer match holds it. Items of more than
    4,096 words are matched in pieces that share all but one word of a window.
    Nulls, empty texts and repeats as in ``contamination``.
    """
    id_field = docs.schema["doc_id"].dataType
    kind = to_arrow_type(id_field)

    def search(block: _Block) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            block = sent.value
            for ids, _, shard in _shards(batches, block):
                query, doc, at, length = shard.matches()
                for k in range(0, len(query), 10_000):
                    some = slice(k, k + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d in doc[some]], kind), pa.array(at[some], pa.int64()),
                         pa.array([block.names[i] for i in block.item[query[some]]], pa.string()),
                         pa.array(block.place[query[some]], pa.int64()), pa.array(length[some], pa.int64())],
                        names=["doc_id", "doc_word", "item_id", "item_word", "n_words"])

        return docs.select("doc_id", "text").mapInArrow(
            run, f"doc_id {id_field.simpleString()}, doc_word long, item_id string, item_word long, n_words long")

    return reduce(DataFrame.unionByName, [search(block) for block in _blocks(benchmark, window, block_bytes)])
